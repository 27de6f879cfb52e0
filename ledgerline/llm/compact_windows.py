"""Repeated passages across documents by compact windows.

A text is a sequence of seeds, strings of SEED words. Under a hash function, the nearest smaller values to the left and right
of a position (its place in the Cartesian tree of the hashes) bound the window within which every stretch around it has that
position's seed as its min-hash. Windows shorter than BLOCK words are left out; about an eighth of the positions remain, and
every stretch of BLOCK words holds one of them, the same in whichever text it stands.

Of two stretches that are alike enough, BLOCK consecutive words at least are equal: skipped shingles of both are at most a
quarter of the shared ones, a gap skips 9 of both (a changed word 10, one put in 9), so there are 36 shared ones a gap at least
and 41 in all, and the longest of the equal blocks has 21 shingles. So both hold a seed within it, and alike stretches always
meet. (Where a text repeats its own words at a gap, such as words said twice in a row, a gap may skip fewer; stretches with
several such gaps may be missed.)

For each seed, the first place of the first document that holds it is the source, and every other is compared with it. Places
that lie in no passage found so far are compared with all earlier places of their seed, by arrays inside the tasks (_further):
rows hold many places each, pairs that cannot be alike fail a bound on the shingles that a stretch skips, and all alike pairs
become rows. So no earlier place is given up, however many share a seed.

Of a chunk of texts only the rows of a seed's first document go to the shuffle under the seed, so that a passage that fills the
corpus sends few rows a chunk; the others follow that document to the source in groups that no seed crowds. Whole copies are
known by their texts' hashes, and only the first of them is looked at. So results don't depend on how texts are dealt over
chunks. Places on one alignment of two texts form runs; the words around a run's places are
compared by blocks of equal shingles with gaps between them, and a stretch of at least `words` words in both texts whose
shingles are alike enough, beginning and ending with equal shingles, is a repeated passage. Its words may be inserted,
deleted or changed, so that ref_start's stretch need not have as many words. Words are compared by 16 bits each, and only in shingles of 80 bits.

Passages word for word do not depend on the source: around all places that met, each stretch of `words` words is looked up
among those of all documents. It holds a seed's place in whichever document it stands, so all repeats are found.

Defined results: null and empty texts and those shorter than a passage have none. Rows with a null doc_id take no part.
Rows that repeat a doc_id are one document if their texts are equal; else each text's passages count for that doc_id. Repeats within one document are not looked for.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._hashing import mix, rolling, text_key, words
from ledgerline.llm._spark import Stash, chunks, map_arrow, sized, texts_of

SHINGLE, WORDS, PERCENT = 5, 50, 80
#: Words of a seed, and of the equal block that two alike stretches hold at least.
SEED, BLOCK = 12, 25
#: Places of one alignment that are so near are one run; and the words that a gap may always have.
REACH = WORDS + SHINGLE
#: Words of context on either side of a run; a longer passage is covered by several runs.
CONTEXT = 2 * REACH
#: Places of a seed that lie in one row when all are compared, and rows of a seed's places that one key deals out.
CROWD, DEALT = 256, 4
#: Pairs of places whose shingles are held side by side at a time.
PAIRS = 2048


def centres(values: np.ndarray, owner: np.ndarray, least: int) -> np.ndarray:
    """Positions whose window (up to the nearest smaller value on either side, within the text) is at least so long. Of equal values the left one counts as smaller."""
    n = len(values)
    if n < least:
        return np.zeros(0, np.int64)
    edge = np.concatenate(([True], owner[1:] != owner[:-1], [True]))
    cuts = np.flatnonzero(edge)
    first, last = np.repeat(cuts[:-1], np.diff(cuts)) - 1, np.repeat(cuts[1:], np.diff(cuts))
    left, right = np.arange(n) - 1, np.arange(n) + 1
    live = np.flatnonzero(left > first)
    while len(live):  # all strictly between left[i] and i is larger than values[i]
        live = live[values[left[live]] > values[live]]
        left[live] = left[left[live]]
        live = live[left[live] > first[live]]
    live = np.flatnonzero(right < last)
    while len(live):
        live = live[values[right[live]] >= values[live]]
        right[live] = right[right[live]]
        live = live[right[live] < last[live]]
    return np.flatnonzero(right - left - 1 >= least)


def _windows(batches):
    for batch in chunks(batches):
        ids = np.asarray(batch.column(0))
        hashes, _, _, owner = words([t.lower() for t in texts_of(batch)])
        size = np.bincount(owner, minlength=len(ids))
        base = np.cumsum(size) - size
        n = max(0, len(hashes) - SEED + 1)
        inside = np.flatnonzero(owner[:n] == owner[len(owner) - n :])
        seeds, own = rolling(hashes, SEED)[inside], owner[inside]
        c = centres(mix(seeds), own, BLOCK - SEED + 1)
        key, doc, place = seeds[c].astype(np.int64), ids[own[c]].astype(np.int64), inside[c] - base[own[c]]
        order = np.lexsort((place, doc, key))
        key, doc, place = key[order], doc[order], place[order]
        # in text that repeats itself a seed's places overlap: of those in one stretch of BLOCK the first and the last stand for all, as a window of BLOCK around one between them holds one of the two
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] // BLOCK != place[:-1] // BLOCK)))[: len(key)]
        kept = fresh | np.concatenate((fresh[1:], [True]))[: len(key)]
        yield _led(key[kept], doc[kept], place[kept])


def _led(key: np.ndarray, doc: np.ndarray, place: np.ndarray) -> pa.RecordBatch:
    """Rows of a chunk in order: all places of a key's first document go on under the key; rows of other documents have met its first place and are dealt by a key of their own."""
    n = len(key)
    first = np.maximum.accumulate(np.where(np.concatenate(([True], key[1:] != key[:-1]))[:n], np.arange(n), 0))
    lead = doc == doc[first]
    spread = np.where(lead, key, mix(key.astype(np.uint64) ^ mix(doc.astype(np.uint64))).astype(np.int64))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (spread, key, doc, place, np.where(lead, 0, doc[first]), np.where(lead, -1, place[first]))], names=["dealt", "key", "doc", "at", "doc2", "at2"])


def _meet(batches):
    """Rows sorted by key, doc and place: each with the first of its key (also further places of the first's own document); and rows that have met the first of their chunk (led)."""
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, doc, at, doc2, at2 = (np.asarray(batch.column(i)) for i in range(1, 6))
        met = at2 >= 0
        k, d, a = key[~met], doc[~met], at[~met]
        out = [(key[met], doc[met], at[met], doc2[met], at2[met])]
        if len(k):
            if last is not None and last[0] == k[0]:
                k, d, a = (np.concatenate(([x], y)) for x, y in zip(last, (k, d, a), strict=True))
            first = np.maximum.accumulate(np.where(np.concatenate(([True], k[1:] != k[:-1])), np.arange(len(k)), 0))
            pair = first != np.arange(len(k))
            out.append((k[pair], d[pair], a[pair], d[first[pair]], a[first[pair]]))
            last = (k[-1], d[first[-1]], a[first[-1]])
        n = len(out[0][0])
        cols = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(np.arange(len(cols[0])) < n)], names=["key", "doc", "at", "doc2", "at2", "led"])


_KEYED = "dealt long, key long, doc long, at long, doc2 long, at2 long"


def _with_first(keyed: DataFrame) -> Stash:
    """(key, doc, at, doc2, at2): each row with the first place of its key among all, as _led() gives them."""
    dealt = keyed.repartition("dealt").sortWithinPartitions("dealt", "doc", "at")
    met = map_arrow(dealt, _meet, "key long, doc long, at long, doc2 long, at2 long, led boolean")
    # rows of a chunk and the row in which the document that leads them met the first of all: as many as a chunk has texts
    met = met.withColumn("lead", F.when(F.col("led"), F.col("doc2")).otherwise(F.col("doc")))
    top = F.first(F.when(~F.col("led") & (F.col("doc") != F.col("doc2")), F.struct("doc2", "at2")), ignorenulls=True).over(Window.partitionBy("key", "lead"))
    met = met.withColumn("top", F.when(F.col("led"), top))
    return Stash(met.select("key", "doc", "at", F.coalesce("top.doc2", "doc2").alias("doc2"), F.coalesce("top.at2", "at2").alias("at2")))


def _whole(width: int):
    """Hashes of the stretches of `width` words around asked places, of each text."""

    def run(batches):
        for batch in chunks(batches):
            ids, asked = np.asarray(batch.column(0)), batch.column(batch.schema.get_field_index("asked"))
            hashes, _, _, owner = words([t.lower() for t in texts_of(batch)])
            size = np.bincount(owner, minlength=len(ids))
            base = np.cumsum(size) - size
            text = np.repeat(np.arange(len(ids)), np.diff(np.asarray(asked.offsets)))
            place = np.asarray(asked.flatten())
            low, high = np.maximum(0, place - width + SEED), np.minimum(place, size[text] - width)
            ok = low <= high
            edges = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(edges, base[text[ok]] + low[ok], 1)
            np.add.at(edges, base[text[ok]] + high[ok] + 1, -1)
            at = np.flatnonzero(np.cumsum(edges) > 0)
            key, doc, start = rolling(hashes, width)[at].astype(np.int64), ids[owner[at]], at - base[owner[at]]
            order = np.lexsort((start, doc, key))
            yield _led(key[order], doc[order], start[order])

    return run


def _text_keys(batches):
    for batch in chunks(batches):
        keys = [text_key(t) for t in texts_of(batch)]
        n = [len(t.split()) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(n, pa.int64())], names=["doc", "k1", "k2", "n_words"])


def _slices(batches):
    """For each asked stretch of a text, 16 bits of each word from CONTEXT before it to CONTEXT + SHINGLE behind it, clipped, and where that starts."""
    for batch in chunks(batches):
        ids, asked = batch.column(0).to_pylist(), batch.column(batch.schema.get_field_index("asked")).to_pylist()
        hashes, _, _, owner = words([t.lower() for t in texts_of(batch)])
        small = (hashes >> np.uint64(48)).astype(np.uint16)
        ends = np.cumsum(np.bincount(owner, minlength=len(ids)))
        docs, lows, highs, begin, seen = [], [], [], [], []
        for t, here in enumerate(asked):
            own = small[ends[t - 1] if t else 0 : ends[t]]
            for x in here:
                if x["hi"] >= len(own):  # asked of another text with this doc_id
                    continue
                lo = max(0, x["lo"] - CONTEXT)
                docs.append(ids[t])
                lows.append(x["lo"])
                highs.append(x["hi"])
                begin.append(lo)
                seen.append(own[lo : x["hi"] + CONTEXT + SHINGLE].tobytes())
        yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (docs, lows, highs, begin)), pa.array(seen, pa.binary())], names=["doc", "lo", "hi", "begin", "seen"])


def _hashed(a: np.ndarray) -> np.ndarray:
    """Shingles of words."""
    n = max(0, len(a) - SHINGLE + 1)
    acc = a[:n].astype(np.uint64)
    for j in range(1, SHINGLE):
        acc = acc * np.uint64(0xD1342543DE82EF95) + a[j : j + n]
    return acc


def _shingled(a: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Shingles of words, as an array and as a list."""
    acc = _hashed(a)
    return acc, acc.tolist()


def _onward(one: tuple, two: tuple, i: int, j: int) -> list[tuple[int, int, int]]:
    """Blocks (place in one, place in two, number) of equal shingles from there on. After each the next begins where the least shingles are skipped in both; no gap is wider than half of what is equal so far (in a stretch that is alike enough the larger part on one side of a gap allows for it), or REACH."""
    (p, a), (q, b) = one, two
    out, equal = [], 0
    while True:
        n = min(len(a) - i, len(b) - j)
        if n:
            differ = p[i : i + n] != q[j : j + n]
            first = int(differ.argmax())
            n = first if differ[first] else n
        out.append((i, j, n))
        i, j, equal = i + n, j + n, equal + n
        wide = max(REACH, equal // 2)
        ahead, near = a[i : i + wide], set(b[j : j + wide])
        if near.isdisjoint(ahead):
            return out
        least, skip = 2 * wide, (0, 0)
        for x, value in enumerate(ahead):
            if x >= least:
                break
            if value in near and x + (y := b.index(value, j) - j) < least:
                least, skip = x + y, (x, y)
        i, j = i + skip[0], j + skip[1]


def stretch(a: np.ndarray, b: np.ndarray, at: int, at2: int, least: int = WORDS, percent: int = PERCENT) -> tuple[int, int, int] | None:
    """Words of two texts. The longest stretch [from, to) of a around its shingle `at`, which b holds at `at2`, and where b's begins: both begin and end with equal shingles, words between may be inserted, deleted or changed, and their shingles are alike enough, if both are long enough."""
    return _stretch(_shingled(a), _shingled(b), at, at2, least, percent)


def _stretch(one: tuple, two: tuple, at: int, at2: int, least: int, percent: int) -> tuple[int, int, int] | None:
    (p, a), (q, b) = one, two
    if at >= len(a) or at2 >= len(b) or a[at] != b[at2]:
        return None
    right = _onward(one, two, at, at2)
    left = [(len(p) - i - n, len(q) - j - n, n) for i, j, n in _onward((p[::-1], a[::-1]), (q[::-1], b[::-1]), len(p) - 1 - at, len(q) - 1 - at2)]
    middle = (left[0][0], left[0][1], left[0][2] + right[0][2] - 1)
    if len(left) == len(right) == 1:  # all is equal
        i, j, n = middle
        return (i, i + n + SHINGLE - 1, j) if n + SHINGLE - 1 >= least else None
    i, j, n = np.array([*left[:0:-1], middle, *right[1:]]).T
    own = len(left) - 1
    total = np.concatenate(([0], np.cumsum(n)))
    span = (i + n)[None, own:] - i[: own + 1, None]
    span2 = (j + n)[None, own:] - j[: own + 1, None]
    shared = total[own + 1 :][None, :] - total[: own + 1][:, None]
    good = (100 * shared >= percent * (span + span2 - shared)) & (np.minimum(span, span2) + SHINGLE - 1 >= least)
    if not good.any():
        return None
    x, y = np.unravel_index(np.where(good, span, 0).argmax(), span.shape)
    return int(i[x]), int(i[own + y] + n[own + y]) + SHINGLE - 1, int(j[x])


def _compare(least: int, percent: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            for r in batch.to_pylist():
                one, two = (_shingled(np.frombuffer(r[x], np.uint16)) for x in ("seen", "seen2"))
                done = -1
                for at in sorted(r["places"]):
                    if at < done:  # within a stretch that was found
                        continue
                    found = _stretch(one, two, at - r["begin"], at + r["shift"] - r["begin2"], least, percent)
                    if found:
                        begin, done = r["begin"] + found[0], r["begin"] + found[1]
                        rows.append((r["doc"], begin, done, r["doc2"], r["begin2"] + found[2] - begin))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc", "start", "stop", "doc2", "shift"])

    return run


def _verified(docs: DataFrame, met: DataFrame, least: int, percent: int) -> Stash:
    """(doc, start, stop, doc2, shift): the alike stretches around places that met, met: (doc, at, doc2, at2)."""
    met = met.select("doc", "doc2", (F.col("at2") - F.col("at")).alias("shift"), "at").distinct()
    line = Window.partitionBy("doc", "doc2", "shift").orderBy("at")
    fresh = (F.col("at") - F.coalesce(F.lag("at").over(line), F.lit(-(1 << 40))) > REACH).cast("int")
    met = met.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(line))
    runs = met.groupBy("doc", "doc2", "shift", "run").agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.collect_list("at").alias("places"))
    runs = Stash(runs.select("doc", "doc2", "shift", "lo", "hi", (F.col("lo") + F.col("shift")).alias("lo2"), (F.col("hi") + F.col("shift")).alias("hi2"), "places"))
    # a source's stretches are few: each is asked for once, however many documents meet it
    sources = runs.read().select(F.col("doc2").alias("doc"), F.col("lo2").alias("lo"), F.col("hi2").alias("hi")).distinct()
    asked = runs.read().select("doc", "lo", "hi").union(sources).distinct()
    asked = Stash(asked.groupBy("doc").agg(F.collect_list(F.struct("lo", "hi")).alias("asked")).withColumnRenamed("doc", "doc_id"))
    held = docs.join(sized(asked.read().select("doc_id")), "doc_id", "left_semi")
    seen = Stash(map_arrow(held.join(asked.read(), "doc_id").select("doc_id", "text", "asked"), _slices, "doc long, lo long, hi long, begin long, seen binary").dropDuplicates(["doc", "lo", "hi", "seen"]))
    second = seen.read().withColumnsRenamed({"doc": "doc2", "lo": "lo2", "hi": "hi2", "begin": "begin2", "seen": "seen2"})
    both = runs.read().join(seen.read(), ["doc", "lo", "hi"]).join(second, ["doc2", "lo2", "hi2"])
    found = Stash(map_arrow(both.select("doc", "lo", "begin", "seen", "doc2", "lo2", "begin2", "seen2", "shift", "places"), _compare(least, percent), "doc long, start long, stop long, doc2 long, shift long").distinct())
    for x in (runs, asked, seen):
        x.drop()
    return found


def _outside(places: DataFrame, spans: DataFrame) -> DataFrame:
    """Those of places (key, doc, at) that lie in no [start, stop) of their document."""
    marks = spans.groupBy("doc", F.col("start").alias("at")).agg(F.max("stop").alias("stop")).select(F.lit(None).cast("long").alias("key"), "doc", "at", "stop")
    # a stretch comes before the places at its start
    line = Window.partitionBy("doc").orderBy("at", F.col("stop").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = places.select("key", "doc", "at", F.lit(None).cast("long").alias("stop")).unionByName(marks)
    return every.withColumn("until", F.max("stop").over(line)).where("key is not null and coalesce(until, -1) <= at").select("key", "doc", "at")


def _around(batches):
    """For each asked place of a text, 16 bits of each word from CONTEXT before it to CONTEXT + SHINGLE behind it, clipped."""
    for batch in chunks(batches):
        ids, asked = batch.column(0).to_pylist(), batch.column(batch.schema.get_field_index("asked")).to_pylist()
        hashes, _, _, owner = words([t.lower() for t in texts_of(batch)])
        small = (hashes >> np.uint64(48)).astype(np.uint16)
        ends = np.cumsum(np.bincount(owner, minlength=len(ids)))
        docs, places, seen = [], [], []
        for t, here in enumerate(asked):
            own = small[ends[t - 1] if t else 0 : ends[t]]
            for at in here:
                if at + SEED <= len(own):  # else asked of another text with this doc_id
                    docs.append(ids[t])
                    places.append(at)
                    seen.append(own[max(0, at - CONTEXT) : at + CONTEXT + SHINGLE].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array(places, pa.int64()), pa.array(seen, pa.binary())], names=["doc", "at", "seen"])


def _centred(seen: list[bytes], at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of shingles for each context, with that of its place at CONTEXT; and where there are words for one."""
    size = np.array([len(x) // 2 for x in seen])
    place = at[:, None] + np.arange(-CONTEXT, CONTEXT + 1)
    there = (place >= 0) & (place <= (size - SHINGLE)[:, None])
    every = _hashed(np.frombuffer(b"".join(seen), np.uint16))
    return every[np.where(there, place + (np.cumsum(size) - size)[:, None], 0)], there


def _gain(one: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    """For each pair what a stretch that takes s shared shingles in this direction is above the bound at most, for s from 0 on.

    one, two: which shingles, outwards, the other holds. Up to the s-th of those, all others are skipped.
    """
    n, size = one.shape
    skipped = np.zeros((n, size + 1), np.int32)
    for held in (one, two):
        row, place = np.nonzero(held)
        count = np.bincount(row, minlength=n)
        rank = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        least = np.full((n, size + 1), 1 << 20, np.int32)
        least[:, 0] = 0
        least[row, rank + 1] = place - rank
        skipped += least
    return (100 - percent) * np.arange(size + 1, dtype=np.int32) - percent * skipped


def _possible(held: np.ndarray, holds: np.ndarray, right: np.ndarray, left: np.ndarray, shared: int, percent: int) -> np.ndarray:
    """Pairs that may be alike by a stretch with gaps. held, holds: for each pair which shingles of the one context the other holds on the same side of its place, and the other way; right, left: how many are equal from the place on and before it.

    A stretch takes all of that equal block and, as the block alone is too short, a shared shingle more at least, and `shared` in all. With
    s shared shingles it skips at most s * (100 - percent) / percent of both, so none that is alike fails this.
    """
    least = np.maximum(shared, right + left + 1)
    out = np.flatnonzero((np.count_nonzero(held, axis=1) >= least) & (np.count_nonzero(holds, axis=1) >= least))
    held, holds, right, left, least = (x[out] for x in (held, holds, right, left, least))
    ahead = _gain(held[:, CONTEXT:], holds[:, CONTEXT:], percent)
    behind = _gain(held[:, CONTEXT - 1 :: -1], holds[:, CONTEXT - 1 :: -1], percent)
    for gain, block in ((ahead, right), (behind, left)):
        gain[np.arange(gain.shape[1]) < block[:, None]] = -(1 << 28)
    best = np.maximum.accumulate(behind[:, ::-1], axis=1)[:, ::-1]
    need = np.maximum(0, least[:, None] - np.arange(ahead.shape[1]))
    fits = need < best.shape[1]
    return out[(fits & (ahead + np.take_along_axis(best, np.where(fits, need, 0), axis=1) >= 0)).any(axis=1)]


def _run(equal: np.ndarray) -> np.ndarray:
    """How many of each row are true from its beginning on."""
    first = equal.argmin(axis=1)
    return np.where(equal[np.arange(len(equal)), first], equal.shape[1], first)


def _times(cell: np.ndarray, codes: np.ndarray, n: int) -> np.ndarray:
    """How often each context holds each of n shingles before its place (0) and from there on (1). cell: where codes has those that count."""
    row, place = np.divmod(cell, codes.shape[1])
    return np.bincount(((place >= CONTEXT) * len(codes) + row) * n + codes.ravel()[cell], minlength=2 * len(codes) * n).reshape(2, len(codes), n).astype(np.float32)


def _met(own: pa.Array | list[dict], others: pa.Array | list[dict], every: bool, least: int, percent: int) -> list[tuple[int, int, int, int]]:
    """(doc, at, doc2, at2): places of earlier documents among others that own ones are like, all or the first of each."""
    own, others = pa.array(own), pa.array(others)
    doc, place, doc2, place2 = (np.asarray(x.field(name)) for x in (own, others) for name in ("doc", "at"))
    order = np.lexsort((place2, doc2))
    doc2, place2 = doc2[order], place2[order]
    seen, raw = own.field("seen").to_pylist(), others.field("seen").to_pylist()
    seen2 = [raw[j] for j in order]
    at, at2 = np.minimum(place, CONTEXT), np.minimum(place2, CONTEXT)
    (one, there), (two, there2) = _centred(seen, at), _centred(seen2, at2)
    # shingles that both sides hold, by numbers; all others are alike to nothing
    known, code = np.unique(one[there], return_inverse=True)
    some = np.zeros(1 << 16, bool)
    some[known >> np.uint64(48)] = True
    cell2 = np.flatnonzero(some[two >> np.uint64(48)] & there2)
    value = two.ravel()[cell2]
    code2 = np.minimum(np.searchsorted(known, value), len(known) - 1)
    cell2, code2 = cell2[known[code2] == value], code2[known[code2] == value]
    both = np.zeros(len(known), bool)
    both[code2] = True
    cell, code, number, none = np.flatnonzero(there)[both[code]], code[both[code]], np.cumsum(both) - 1, int(both.sum())
    mine, theirs = np.full(one.shape, none), np.full(two.shape, none + 1)
    mine.ravel()[cell], theirs.ravel()[cell2] = number[code], number[code2]
    times, times2 = _times(cell, mine, none + 2), _times(cell2, theirs, none + 2)
    holds, holds2 = (times > 0).astype(np.float32), (times2 > 0).astype(np.float32)
    # a stretch shares no more shingles than either context holds of the other's, on each side of the place
    most = sum(np.minimum(times[x] @ holds2[x].T, holds[x] @ times2[x].T) for x in range(2))
    # the fewest shared shingles that a stretch has: a shingle more than `least` words make is skipped on either side
    shared = -(-2 * percent * (least - SHINGLE + 1) // (100 + percent))
    meets = (most >= shared) & (doc2 < doc[:, None])
    for i, but in enumerate(own.field("but").to_pylist()):
        if but:
            meets[i] &= ~np.isin(doc2, but)
    i, j = np.nonzero(meets)
    sure, maybe = np.zeros(len(i), bool), np.zeros(len(i), bool)
    side = (np.arange(mine.shape[1]) >= CONTEXT).astype(int)
    for lo in range(0, len(i), PAIRS):
        m, n = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
        equal = mine[m] == theirs[n]
        right, left = _run(equal[:, CONTEXT:]), _run(equal[:, CONTEXT - 1 :: -1])
        # an equal block that is long enough is alike as it is
        sure[lo : lo + PAIRS] = (right > 0) & (right + left + SHINGLE - 1 >= least)
        rest = np.flatnonzero((right > 0) & (right + left + SHINGLE - 1 < least) & (most[m, n] > right + left))
        m, n = m[rest, None], n[rest, None]
        maybe[lo + rest[_possible(holds2[side, n, mine[m[:, 0]]] > 0, holds[side, m, theirs[n[:, 0]]] > 0, right[rest], left[rest], shared, percent)]] = True
    out, met = [], -1
    shingles: dict[tuple[bool, int], tuple] = {}

    def shingled(which: bool, k: int) -> tuple:
        if (which, k) not in shingles:
            shingles[which, k] = _shingled(np.frombuffer((seen2 if which else seen)[k], np.uint16))
        return shingles[which, k]

    for x in np.flatnonzero(sure | maybe):
        m, n = int(i[x]), int(j[x])
        if (every or m != met) and (sure[x] or _stretch(shingled(False, m), shingled(True, n), int(at[m]), int(at2[n]), least, percent)):
            met = m
            out.append((int(doc[m]), int(place[m]), int(doc2[n]), int(place2[n])))
    return out


def _tiles(least: int, percent: int):
    def run(batches):
        for batch in batches:
            for one in range(batch.num_rows):  # a row holds many contexts
                own, others = (batch.column(i)[one].values for i in range(2))
                if rows := _met(own, others, batch.column(2)[one].as_py(), least, percent):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc", "at", "doc2", "at2"])

    return run


def _further(docs: DataFrame, members: Stash, copies: DataFrame, least: int, percent: int) -> list[Stash]:
    """Stretches around own places of members (g, doc, at, own): of those that share a seed (g), beside all that are in earlier documents.

    Places of a seed lie in rows of about CROWD with the words around them, and each row of own ones meets all rows of its seed. Pairs
    are bounded by arrays of shared shingles inside the task, and all that are alike leave it, however many places the seed has.
    """
    asked = Stash(members.read().groupBy("doc").agg(F.collect_set("at").alias("asked")).withColumnRenamed("doc", "doc_id"))
    near = Stash(map_arrow(docs.join(sized(asked.read()), "doc_id").select("doc_id", "text", "asked"), _around, "doc long, at long, seen binary").dropDuplicates(["doc", "at"]))
    size, each = max(1, CROWD), F.xxhash64("doc", "at")
    rows_of = lambda n: F.ceil(F.col(n) / size)
    sizes = members.read().groupBy("g").agg(F.count("*").alias("n"), F.count(F.when(F.col("own"), 1)).alias("k"), F.min("doc").alias("low"), F.max(F.when(F.col("own"), F.col("doc"))).alias("high"))
    sizes = Stash(sizes.where("k > 0 and low < high").withColumn("parts", F.ceil(rows_of("n") / DEALT)))
    context = Stash(members.read().join(sized(sizes.read()), "g").where("doc <= high").join(near.read(), ["doc", "at"]))
    others = context.read().withColumn("row", F.pmod(each, rows_of("n")))
    others = others.groupBy("g", "row", (F.col("row") % F.col("parts")).alias("part")).agg(F.collect_list(F.struct("doc", "at", "seen")).alias("others"))
    but = Stash(copies.groupBy("doc").agg(F.collect_set("doc2").alias("but")))
    # fewer own places a row, as arrays of all shingles of both are made
    own = context.read().where("own").join(sized(but.read()), "doc", "left").withColumn("row", F.pmod(each, F.ceil(8 * F.col("k") / size)))
    own = own.groupBy("g", "row", "parts").agg(F.collect_list(F.struct("doc", "at", "seen", "but")).alias("own"))
    own = own.select("g", F.lit(True).alias("every"), "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    # rows hold few bytes for their work, so partitions aren't put together by size
    dealt = lambda df: df.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "g", "part")
    met = Stash(map_arrow(dealt(own).join(dealt(others), ["g", "part"]).select("own", "others", "every", "g"), _tiles(least, percent), "doc long, at long, doc2 long, at2 long"))
    found = [] if met.read().isEmpty() else [_verified(docs, met.read(), least, percent)]
    for x in (asked, near, members, sizes, context, but, met):
        x.drop()
    return found


def repeated_passages(docs: DataFrame, words_: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, start, n_words, ref_doc_id, ref_start): words [start, start + n_words) of doc_id repeat those of ref_doc_id from ref_start, where ref_doc_id, an earlier document, holds the passage; the first document with a passage is not listed for it."""
    if words_ < WORDS:
        raise ValueError(f"passages have {WORDS} words at least")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    # whole copies need no look at their words
    texts = Stash(map_arrow(docs, _text_keys, "doc long, k1 long, k2 long, n_words long").where(F.col("n_words") >= words_).dropDuplicates(["doc", "k1", "k2"]))
    single = texts.read().groupBy("doc").agg(F.count("*").alias("n")).where("n = 1").select("doc")
    firsts = texts.read().groupBy("k1", "k2").agg(F.min("doc").alias("doc2"), F.count("*").alias("n")).where("n > 1").drop("n")
    copies = Stash(texts.read().join(firsts, ["k1", "k2"]).where("doc <> doc2").select("doc", "doc2", F.col("n_words").alias("n")))
    copied = Stash(copies.read().select("doc").join(single, "doc", "left_semi").withColumnRenamed("doc", "doc_id"))
    docs = docs.join(sized(copied.read()), "doc_id", "left_anti")
    met = _with_first(map_arrow(docs, _windows, _KEYED))
    # stretches of `words_` words: whoever holds one meets under a key within it, so its first document is found among all, whatever part of it the key's source holds
    places = met.read().select(F.explode(F.array(F.struct("doc", "at"), F.struct(F.col("doc2").alias("doc"), F.col("at2").alias("at")))).alias("p")).select("p.*")
    places = Stash(places.groupBy("doc").agg(F.collect_set("at").alias("asked")).withColumnRenamed("doc", "doc_id"))
    holders = docs.join(sized(places.read().select("doc_id")), "doc_id", "left_semi").join(places.read(), "doc_id").select("doc_id", "text", "asked")
    equal = _with_first(map_arrow(holders, _whole(words_), _KEYED)).read().where("doc <> doc2").select("doc", F.col("at").alias("start"), (F.col("at") + words_).alias("stop"), "doc2", (F.col("at2") - F.col("at")).alias("shift"))
    rest = met.read().where("doc <> doc2").join(sized(copies.read().select("doc", "doc2")), ["doc", "doc2"], "left_anti")
    found = [_verified(docs, rest, words_, percent)]
    left = Stash(_outside(rest.select("key", "doc", "at").distinct(), found[0].read().unionByName(equal)))
    # all other places of the seeds of those that are left, which have met the first
    keys = Stash(left.read().groupBy("key").agg(F.max("doc").alias("high")))
    every = met.read().where("doc <> doc2 or at <> at2").select("key", "doc", "at").distinct().join(sized(keys.read()), "key").where("doc <= high").drop("high")
    members = Stash(every.join(left.read().withColumn("own", F.lit(True)), ["key", "doc", "at"], "left").select(F.col("key").alias("g"), "doc", "at", F.coalesce("own", F.lit(False)).alias("own")))
    found += _further(docs, members, sized(copies.read().select("doc", "doc2")), words_, percent)
    # stretches of one alignment that touch are one passage
    along = Window.partitionBy("doc", "doc2", "shift").orderBy("start", "stop")
    spans = reduce(DataFrame.unionByName, [f.read() for f in found]).unionByName(equal).withColumn("fresh", (F.col("start") > F.coalesce(F.max("stop").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))).cast("int"))
    spans = spans.withColumn("island", F.sum("fresh").over(along)).groupBy("doc", "doc2", "shift", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    parts = spans.select(F.col("doc").alias("doc_id"), "start", (F.col("stop") - F.col("start")).alias("n_words"), F.col("doc2").alias("ref_doc_id"), (F.col("start") + F.col("shift")).alias("ref_start"))
    whole = copies.read().select(F.col("doc").alias("doc_id"), F.lit(0).cast("long").alias("start"), F.col("n").alias("n_words"), F.col("doc2").alias("ref_doc_id"), F.lit(0).cast("long").alias("ref_start"))
    for x in (met, texts, left):
        x.drop()
    return whole.unionByName(parts)


def _cut(batches):
    for batch in chunks(batches):
        spans = batch.column(batch.schema.get_field_index("own_spans")).to_pylist()
        texts = texts_of(batch)
        _, starts, ends, owner = words(texts)
        to = np.cumsum(np.bincount(owner, minlength=len(texts)))
        base = np.cumsum([1, *(len(t) + 1 for t in texts)])
        out, left = [], []
        for t, text in enumerate(texts):
            lo = to[t - 1] if t else 0
            n = int(to[t] - lo)
            if spans[t] is None:
                out.append(text)
                left.append(n)
                continue
            gone = np.zeros(n + 1, np.int64)
            for s in spans[t]:
                gone[min(n, s["start"])] += 1
                gone[min(n, s["stop"])] -= 1
            gone = np.cumsum(gone)[:n] > 0
            parts, at = [], 0
            edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(np.int8), [0]))))
            for a, b in edge.reshape(-1, 2):
                parts.append(text[at : starts[lo + a] - base[t]])
                at = ends[lo + b - 1] - base[t]
            parts.append(text[at:])
            out.append(b"".join(parts).strip())
            left.append(n - int(gone.sum()))
        cols = [c for n, c in zip(batch.schema.names, batch.columns, strict=True) if n not in ("text", "own_spans")]
        names = [n for n in batch.schema.names if n not in ("text", "own_spans")]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(out, pa.binary()).cast(pa.string()), pa.array(left, pa.int64())], names=[*names, "text", "own_left"])


def remove_passages(docs: DataFrame, passages: DataFrame) -> DataFrame:
    """docs without those passages; a document of which no word is left goes. Columns, also those with clashing names, stay; n_chars, if there, is set anew. Null texts stay."""
    cols = docs.columns
    inner = docs.toDF(*(c if c == "text" else f"c{i}" for i, c in enumerate(cols)))
    key = inner.columns[cols.index("doc_id")]
    spans = Stash(passages.groupBy("doc_id").agg(F.collect_list(F.struct("start", (F.col("start") + F.col("n_words")).alias("stop"))).alias("own_spans")).withColumnRenamed("doc_id", "own_key"))
    joined = inner.join(sized(spans.read()), inner[key] == F.col("own_key"), "left").drop("own_key")
    kept = joined.where("own_spans is null").drop("own_spans")
    fields = [f for f in inner.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "text string", "own_left long"])
    cut = map_arrow(joined.where("own_spans is not null"), _cut, schema).where("own_left > 0")
    if "n_chars" in cols:
        name = inner.columns[cols.index("n_chars")]
        cut = cut.withColumn(name, F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return kept.select(inner.columns).unionByName(cut.select(inner.columns)).toDF(*cols)
