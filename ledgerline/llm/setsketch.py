"""Near-duplicate documents by SetSketch registers.

Every document becomes its set of word shingles. For each of M registers the smallest of exponentially
distributed hashes over the set is kept, on an exponential scale and truncated (a register holds
floor(1 - log_b(min)) within [0, Q + 1]); such registers merge by maximum and agree between two sets the
more often the more alike they are. Bands of registers give candidate pairs, a likelihood estimate from the
registers of both sides drops those that are far off, and the full sets decide.

Work stays near linear in a bucket's size: each bucket is compared with its member that meets most others over all bands,
the links found are contracted, and only members of a bucket that still lie in different parts are looked at further. For
those, shingles that no other of them holds are counted out, and what is left bounds any intersection. A pair that could
still reach the threshold either shares a shingle that few of them hold, and is found by that, or shares common ones only,
and then its bound counts only those. These steps are exact: no link between different parts of a bucket is skipped. A bucket of copies costs one comparison a member.

Defined results: a null text is like an empty one: it has no shingles and is linked with nothing. Rows with a null
doc_id take no part. Repeated rows give repeated results. Rows with one doc_id and different texts are sets of their own, but one
document: what either is linked with is reachable from both. Other columns, whatever their names, are not read. An
empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm._hashing import mix, shingles, words
from ledgerline.llm._spark import Stash, chunks, components, map_arrow, sized, texts_of

#: Registers, rows in a band, base and largest value of the scale, rate of the exponential hashes.
BANDS, ROWS = 40, 6
M = BANDS * ROWS
BASE, RATE, Q = 1.001, 20.0, (1 << 16) - 2
#: The estimate has a standard deviation of about 0.03 at a similarity of 0.8; pairs this far below the threshold go.
MARGIN = 0.22
#: Shingles that at most so many documents hold are rare.
RARE = 8


def registers(windows: np.ndarray, owner: np.ndarray, count: np.ndarray) -> np.ndarray:
    """uint16 [texts, M]. windows: distinct hashes, owner: their text, count: distinct hashes of each text.

    An element's hashes for the M registers are the first arrivals of M Poisson processes: arrivals at rate
    M * RATE, each at a register drawn evenly. Only arrivals up to a time by which all registers of the text are very
    likely filled are drawn; a text with a register left open is drawn again up to twice that time.
    """
    least = np.full((len(count), M), np.inf)
    flat = least.reshape(-1)
    open_, slack = count > 0, 5.0
    while open_.any():
        until = np.where(open_, (math.log(M) + slack) / np.maximum(count, 1), -1.0)
        live = np.flatnonzero(open_[owner])
        state, own = windows[live], owner[live]
        t = np.zeros(len(live))
        limit = until[own]
        while len(state):
            state = mix(state)
            t = t - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / M
            keep = t <= limit
            state, own, t, limit = state[keep], own[keep], t[keep], limit[keep]
            at = (mix(state ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32)) * np.uint64(M) >> np.uint64(32)
            np.minimum.at(flat, own * M + at.astype(np.int64), t)
        open_ = open_ & np.isinf(least).any(axis=1)
        slack *= 2
    with np.errstate(divide="ignore"):
        scaled = np.floor(1.0 - np.log(least / RATE) / math.log(BASE))
    return np.where(count[:, None] > 0, np.clip(scaled, 0, Q + 1), 0).astype(np.uint16)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The similarity under which the numbers of smaller, larger and equal registers are likeliest, on a grid of 1/200."""
    less, more = (a < b).sum(axis=1), (a > b).sum(axis=1)
    equal = a.shape[1] - less - more
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    top = np.minimum(u / v, v / u)
    part = lambda x: np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE), 1e-12, 1)
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    for step in range(201):
        j = np.minimum(step / 200, top)
        gain, loss = part(u - v * j), part(v - u * j)
        like = more * np.log(gain) + less * np.log(loss) + equal * np.log(np.maximum(1 - gain - loss, 1e-12))
        better = like > best
        best, at = np.where(better, like, best), np.where(better, j, at)
    return at


def _distinct(windows: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct windows of each text, and their numbers."""
    parts, ends = [], np.cumsum(count)
    for to, n in zip(ends, count, strict=True):
        parts.append(np.unique(windows[to - n : to]))
    return (np.concatenate(parts) if parts else windows), np.array([len(p) for p in parts], dtype=np.int64)


def _sketcher(k: int):
    def run(batches):
        for batch in chunks(batches):
            texts = [t.lower() for t in texts_of(batch)]
            hashes, _, _, owner = words(texts)
            found, count = shingles(hashes, owner, len(texts), k)
            found, count = _distinct(found, count)
            own = np.repeat(np.arange(len(texts)), count)
            sums = []
            for salt in (0x51A1, 0xC0DE):
                total = np.zeros(len(found) + 1, dtype=np.uint64)
                np.cumsum(mix(found ^ np.uint64(salt)), out=total[1:])
                ends = np.cumsum(count)
                sums.append((total[ends] - total[ends - count]).astype(np.int64))
            regs = registers(found, own, count)
            keys = np.zeros((len(texts), BANDS), dtype=np.uint64)
            parts = regs.reshape(len(texts), BANDS, ROWS).astype(np.uint64)
            for r in range(ROWS):
                keys = mix(keys ^ parts[:, :, r])
            keys = mix(keys ^ np.arange(BANDS, dtype=np.uint64)).astype(np.int64)
            # one bit of each register, for a cheap test inside joins
            odd = np.packbits(mix(regs.astype(np.uint64)) >> np.uint64(63) == 1, axis=1)
            odd = np.pad(odd, ((0, 0), (0, -odd.shape[1] % 8))).copy().view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("doc_id")),
                    pa.array(count),
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                    pa.array([x.tobytes() for x in regs], pa.binary()),
                    pa.array(list(odd), pa.list_(pa.int64())),
                    pa.array(list(keys), pa.list_(pa.int64())),
                ],
                names=["doc_id", "n", "s1", "s2", "regs", "odd", "bands"],
            )

    return run


def _grams(k: int):
    """A row for each distinct shingle of each text."""

    def run(batches):
        for batch in chunks(batches):
            texts = [t.lower() for t in texts_of(batch)]
            hashes, _, _, owner = words(texts)
            found, count = _distinct(*shingles(hashes, owner, len(texts), k))
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(np.repeat(np.arange(len(texts)), count)))
            yield pa.RecordBatch.from_arrays([ids, pa.array(found.astype(np.int64))], names=["doc_id", "gram"])

    return run


def _shared(ids: DataFrame, docs: DataFrame, k: int) -> Stash:
    """(doc_id, gram, rare): the distinct shingles of those documents that another of them holds as well; rare: at most RARE hold it."""
    texts = docs.join(sized(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    grams = map_arrow(texts, _grams(k), "doc_id long, gram long")
    common = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    return Stash(grams.join(common, "gram").select("doc_id", "gram", (F.col("df") <= RARE).alias("rare")))


def _likely(threshold: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            col = lambda c, b=batch: b.column(b.schema.get_field_index(c))
            a, b = (np.frombuffer(b"".join(col(c).to_pylist()), dtype=np.uint16).reshape(-1, M) for c in ("ra", "rb"))
            at = estimate(a, b, np.asarray(col("na")).astype(float), np.asarray(col("nb")).astype(float))
            yield batch.select(["u", "v"]).filter(pa.array(at >= threshold - MARGIN))

    return run


def _sure(k: int, percent: int):
    def grams(text: bytes) -> set:
        parts = text.lower().split()
        return {tuple(parts[i : i + k]) for i in range(max(1, len(parts) - k + 1))} if parts else set()

    def run(batches):
        for batch in batches:
            keep, last, left = [], None, set()
            us, ta, tb = batch.column(0).to_pylist(), texts_of(batch, "ta"), texts_of(batch, "tb")
            for u, x, y in zip(us, ta, tb, strict=True):
                if u != last:
                    last, left = u, grams(x)
                right = grams(y)
                both = len(left & right)
                keep.append(100 * both >= percent * (len(left) + len(right) - both) and both > 0)
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _confirm(pairs: DataFrame, reps: DataFrame, docs: DataFrame, k: int, percent: int, rows: int) -> Stash:
    """Those pairs (u, v) of representatives whose full sets are alike enough."""
    side = lambda x, y: reps.select(F.col("doc_id").alias(x), F.col("n").alias(f"n{y}"), F.col("regs").alias(f"r{y}"))
    close = pairs.join(side("u", "a"), "u").join(side("v", "b"), "v")
    close = close.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
    near = Stash(map_arrow(close.select("u", "v", "na", "nb", "ra", "rb"), _likely(percent / 100), "u long, v long"), rows)
    ids = Stash(near.read().select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), rows)
    # the same doc_id can stand in several rows; the smallest text stands for it everywhere
    texts = Stash(docs.join(sized(ids.read()), "doc_id", "left_semi"))
    texts_in = lambda x, y: texts.read().groupBy("doc_id").agg(F.min("text").alias(y)).withColumnRenamed("doc_id", x)
    both = near.read().join(texts_in("u", "ta"), "u").join(texts_in("v", "tb"), "v")
    sure = Stash(map_arrow(both.select("u", "v", "ta", "tb"), _sure(k, percent), "u long, v long"))
    for x in (near, ids, texts):
        x.drop()
    return sure


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for each row of docs (doc_id, text) with a doc_id.

    Documents are linked if 100 * |A and B| >= percent * |A or B| for their sets of k-word shingles (words: runs of
    bytes other than x20 and x09 to x0D, A to Z lower-cased; with fewer words the whole sequence is one shingle).
    component_id: the smallest doc_id reachable over links. n_links: confirmed links of the document's class.
    """
    docs = docs.select("doc_id", "text").where("doc_id is not null")
    sketch = Stash(map_arrow(docs, _sketcher(k), "doc_id long, n long, s1 long, s2 long, regs binary, odd array<long>, bands array<long>"))
    rows = sketch.read().count()
    spread = [F.min(c) != F.max(c) for c in ("s1", "s2", "n")]
    if sketch.read().where("n > 0").groupBy("doc_id").agg((spread[0] | spread[1] | spread[2]).alias("several")).where("several").limit(1).count():
        sketch.drop()
        return _by_row(docs, k, percent)
    narrow = sketch.read().where("n > 0").select("doc_id", "s1", "s2", "n")
    classes = Stash(narrow.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep")), rows)
    firsts = classes.read().select(F.col("rep").alias("doc_id"), "s1", "s2", "n")
    reps = Stash(sketch.read().join(firsts, ["doc_id", "s1", "s2", "n"], "left_semi").dropDuplicates(["doc_id"]).select("doc_id", "n", "regs", "odd", "bands"))

    bands = reps.read().select("doc_id", F.explode("bands").alias("key"))
    sizes = bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    crowded = Stash(bands.join(sizes, "key"), 4 * rows)
    weight = Stash(crowded.read().groupBy("doc_id").agg(F.sum("size").alias("weight")), rows)
    weighed = crowded.read().join(sized(weight.read()), "doc_id").select("key", "doc_id", "weight")
    # the order of (weight, id) as two plain maxima, which aggregate in hash tables
    heaviest = weighed.groupBy("key").agg(F.max("weight").alias("most"))
    centres = weighed.join(heaviest, "key").where("weight = most").groupBy("key").agg(F.min("doc_id").alias("centre"))
    members = Stash(crowded.read().select("key", "doc_id").join(centres, "key"), 4 * rows)
    star = members.read().where("doc_id <> centre").select(F.least("doc_id", "centre").alias("u"), F.greatest("doc_id", "centre").alias("v")).distinct()
    tried = Stash(star, rows)
    links = _confirm(tried.read(), reps.read(), docs, k, percent, rows)
    first = Stash(components(links.read(), rows), rows)

    part = members.read().join(first.read().withColumnRenamed("id", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("comp", "doc_id").alias("comp"))
    part = Stash(part, 4 * rows)
    open_ = part.read().groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    open_part = Stash(part.read().join(open_, "key"), 4 * rows)
    grams = _shared(open_part.read().select("doc_id").distinct(), docs, k)
    counts = Stash(grams.read().groupBy("doc_id").agg(F.count("*").alias("shared"), F.count_if(~F.col("rare")).alias("common")), rows)
    # an intersection with any other is at most `shared`, a union at least n: those below the threshold have no links
    able = reps.read().join(sized(counts.read()), "doc_id").where(f"100 * shared >= {percent} * n").select("doc_id", "n", "odd", "shared", "common")
    able = Stash(able.join(part.read().select("doc_id", "comp").distinct(), "doc_id"), rows)
    words_ = -(-M // 64)
    unlike = sum((F.bit_count(F.get("ou", F.lit(i)).bitwiseXOR(F.get("ov", F.lit(i)))) for i in range(words_)), F.lit(0))
    # equal registers give equal bits, others a fair coin: at a similarity s, M * (1 - s) / 2 bits differ on average
    most = M * (1 - percent / 100 + MARGIN) / 2 + 4
    enough = lambda c: 100 * F.least(f"{c}u", f"{c}v") >= percent * (F.col("nu") + F.col("nv") - F.least(f"{c}u", f"{c}v"))
    # a pair either shares a rare shingle, or all that it shares is common, and so bounded by the common ones of each
    near = lambda c: (F.col("cu") != F.col("cv")) & (F.col("u") < F.col("v")) & (100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")) & (unlike <= most) & enough(c)
    sides = lambda df, *keep: (df.select(*keep, *(F.col(c).alias(f"{y}{x}" if y else x) for c, y in (("doc_id", ""), ("comp", "c"), ("n", "n"), ("odd", "o"), ("shared", "s"), ("common", "g"), ("keys", "k")))) for x in "uv")
    # at most BANDS keys each; a pair that shares several of them is made under the smallest alone
    keys = open_part.read().groupBy("doc_id").agg(F.collect_set("key").alias("keys"))
    rest = Stash(open_part.read().select("key", "doc_id").join(able.read().join(keys, "doc_id"), "doc_id"), 4 * rows)
    a, b = sides(rest.read(), "key")
    least = F.array_min(F.array_intersect("ku", "kv"))
    alike = a.join(b, (a["key"] == b["key"]) & near("g") & (a["key"] == least)).select("u", "v")
    rare = Stash(grams.read().where("rare").select("doc_id", "gram").join(able.read().select("doc_id", "comp", "n", "shared", "common"), "doc_id"))
    both = [rare.read().select("gram", F.col("doc_id").alias(x), *(F.col(c).alias(f"{y}{x}") for c, y in (("comp", "c"), ("n", "n"), ("shared", "s"), ("common", "g")))) for x in "uv"]
    fits = (F.col("cu") != F.col("cv")) & (F.col("u") < F.col("v")) & (100 * F.least("nu", "nv") >= percent * F.greatest("nu", "nv")) & enough("s") & ~enough("g")
    met = both[0].join(both[1], (both[0]["gram"] == both[1]["gram"]) & fits).groupBy("u", "v").agg(F.count("*").alias("r"), F.min(F.least("gu", "gv")).alias("g"), F.min(F.col("nu") + F.col("nv")).alias("nn"))
    # what they share: their rare shingles in common, counted here, and common ones
    held = met.where(f"100 * (g + r) >= {percent} * (nn - g - r)").select("u", "v")
    more = alike.unionByName(held).distinct().join(tried.read(), ["u", "v"], "left_anti")
    late = _confirm(Stash(more, rows).read(), reps.read(), docs, k, percent, rows)

    every = Stash(links.read().unionByName(late.read()), rows)
    labels = components(every.read(), rows) if late.read().limit(1).count() else first.read()
    degree = every.read().select(F.explode(F.array("u", "v")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    named = classes.read().join(labels.withColumnRenamed("id", "rep"), "rep", "left").join(degree, "rep", "left")
    named = Stash(named.select("s1", "s2", F.col("n").alias("cn"), F.coalesce("comp", "rep").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")), rows)
    each, named = sketch.read().select("doc_id", "n", "s1", "s2"), named.read().withColumnsRenamed({"s1": "c1", "s2": "c2"})
    out = each.join(named, (F.col("s1") == F.col("c1")) & (F.col("s2") == F.col("c2")) & (F.col("n") == F.col("cn")), "left")
    for x in (crowded, weight, members, tried, part, open_part, grams, counts, able, rest, rare):
        x.drop()
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def _by_row(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """near_duplicates where a doc_id stands for different texts: rows are compared under numbers of their own, and parts that share a doc_id are one."""
    numbered = Stash(docs.withColumn("row", F.monotonically_increasing_id()))
    found = Stash(near_duplicates(numbered.read().select(F.col("row").alias("doc_id"), "text"), k, percent).withColumnRenamed("doc_id", "row"))
    labels = Stash(found.read().join(numbered.read().select("row", "doc_id"), "row"))
    rows = labels.read().count()
    linked = labels.read().where("n_shingles > 0")
    least = linked.groupBy("doc_id").agg(F.min("component_id").alias("u"))
    joins = linked.join(least, "doc_id").where("u <> component_id").select("u", F.col("component_id").alias("v")).distinct()
    merged = components(joins, rows)
    named = labels.read().join(merged.withColumnRenamed("id", "component_id"), "component_id", "left").withColumn("part", F.coalesce("comp", "component_id"))
    first = named.groupBy("part").agg(F.min("doc_id").alias("least"))
    return named.join(first, "part").select("doc_id", "n_shingles", F.col("least").alias("component_id"), "n_links")
