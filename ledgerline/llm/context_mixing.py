"""Language-model scores by logistic context mixing, beside a smoothed unigram count.

A text is coded bit by bit. For each bit, the counts of zeros and ones seen in training after the same context (the
last bytes, as many as each of ORDERS says, and the bits of the byte so far) give a prediction each. Beyond ACROSS bytes a
context ends at the last white space, so that the longest ones are the word so far. The predictions are mixed in the logistic domain by
weights that are gated by the bit's place and by how often two contexts were seen, learned online, and the result is refined by
an adaptive map over the byte so far. The sum over bits is the text's probability; total bits per byte follow.

A window, a byte with the BACK bytes before it, holds all contexts of that byte as one 64-bit number, so counts are exact
and need no table of a fixed size. What is gathered is the number of each distinct window of all training texts, and it grows
with them. Windows are dealt by the last SPLIT + 1 bytes of their context: all that share so long a context are in one task, and shorter contexts
come from a table of at most 256**(SPLIT + 1) rows. Each task learns weights online over its windows, each counted
as often as it occurs with one occurrence left out; their mean by number of bytes is the model's, and sums for the adaptive map add up. A second
pass gives each window its cost, as the model then stands still.

Texts meet costs as they meet word counts: the commonest windows and words, TOP at most of each, go to the tasks;
all others of a text meet theirs in a join. Unigram counts are over hashes of words (64 bits).

Defined results: a null text is like an empty one (one end token). A row with a null doc_id is
not held out and is learned from. Repeated rows count and are scored each. Without training texts every count is 0 and every bit
costs one bit. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm._hashing import words
from ledgerline.llm._spark import Stash, chunks, map_arrow, texts_of

ORDERS, ACROSS, SPLIT = (1, 2, 3, 4, 5, 7), 4, 2
BACK, KINDS = max(ORDERS), len(ORDERS)
#: Words and windows that go to the tasks at most, distinct windows that a task of counting holds, and that a task of learning has about.
TOP, HELD, PART = 1 << 20, 1 << 20, 1 << 16
RATE, ROUNDS, BATCH, PRIOR, FIRST = 0.1, 2, 1024, 0.05, 0.3
#: Contexts (places in ORDERS) whose counts choose the weights, and steps of those counts.
GATED, LEVELS = (3, 5), 8
CELLS = 33
#: The end token's place among word hashes.
END = -(1 << 63) + 12345
_PAD = b"\0" * BACK
#: The lowest k + 1 bytes.
_MASKS = np.array([(1 << 8 * (k + 1)) - 1 for k in range(BACK + 1)], dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\x0b\x0c\r\0")] = True


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of each text and one closing 0, itself and the BACK bytes before it (0 where a context doesn't reach) as one number, lowest byte first, and the text's index."""
    joined = _PAD + b"".join(t + b"\0" + _PAD for t in texts)
    raw = np.frombuffer(joined, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + BACK)[:-1])) + BACK
    owner = np.repeat(np.arange(len(texts)), sizes)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begins[owner]
    # eight bytes from each place on, as numbers whose lowest byte is the last
    every = np.ndarray(len(raw) - BACK, dtype=">u8", buffer=raw, strides=(1,))
    back = at - BACK
    packed = every[back].astype(np.uint64)
    # bytes before the last white space do not count, unless they are near
    place = np.arange(len(raw), dtype=np.int32)
    space = np.maximum.accumulate(np.where(_SPACE[raw], place, 0))
    far = np.clip(at - space[at - 1], ACROSS, BACK)
    packed &= _MASKS[far]
    return packed.view(np.int64), owner


def _low(packed: np.ndarray, order: int) -> np.ndarray:
    """The byte and `order` bytes of its context."""
    return packed.view(np.uint64) & np.uint64((1 << 8 * (order + 1)) - 1)


def _levels(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """[9, keys]: how often the context of each key was seen with the first 0, 1, ... 8 bits of the key's byte."""
    order = np.argsort(keys, kind="stable")
    ordered, counts = keys[order], n[order]
    out = np.empty((9, len(keys)), np.float32)
    for bit in range(9):
        group = ordered >> np.uint64(8 - bit)
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        out[bit, order] = np.repeat(np.add.reduceat(counts, first), np.diff(np.append(first, len(keys))))
    return out


def seen(packed: np.ndarray, n: np.ndarray, short: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """[KINDS, 9, windows]: _levels of each context. short: the table of windows of SPLIT + 1 bytes and their numbers."""
    keys, counts = short
    row = np.searchsorted(keys, _low(packed, SPLIT))
    return np.stack([_levels(_low(packed, o), n) if o > SPLIT else _levels(_low(keys, o), counts)[:, row] for o in ORDERS])


def _inputs(levels: np.ndarray, out: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Of levels without `out` occurrences: how each context speaks for the byte's own bits [KINDS, 8, windows], and the set of weights [8, windows]."""
    same = np.maximum(levels[:, 1:] - out, 0)
    total = np.maximum(levels[:, :-1] - out, 0)
    step = np.minimum(np.log2(total[list(GATED)] + 1).astype(np.int64), LEVELS - 1)
    gate = (np.arange(8)[:, None] * LEVELS + step[1]) * LEVELS + step[0]
    return np.log((same + PRIOR) / (total - same + PRIOR)), gate


def _squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -20, 20)))


def _bits(packed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte's bits [8, windows], and 1 followed by those before each."""
    bit = np.arange(8)[:, None]
    byte = packed & 255
    return (byte >> (7 - bit)) & 1, (1 << bit) | (byte >> (8 - bit))


def _cells(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.clip((x + 12) * ((CELLS - 1) / 24), 0, CELLS - 1.001)
    low = at.astype(np.int64)
    return low, at - low


def learn(packed: np.ndarray, n: np.ndarray, levels: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights [8 * LEVELS**2, KINDS] after ROUNDS online passes over the windows that occur, and sums [2, 256 * CELLS] for the map."""
    weights = np.full((8 * LEVELS * LEVELS, KINDS), FIRST)
    use = np.flatnonzero(n > 0)
    draw = np.random.default_rng(seed)
    sums = np.zeros((2, 256 * CELLS))
    for learning in [True] * ROUNDS + [False]:
        use = draw.permutation(use)
        for at in range(0, len(use), BATCH if learning else 16 * BATCH):
            part = use[at : at + (BATCH if learning else 16 * BATCH)]
            x, gate = _inputs(levels[:, :, part], 1)
            dot = np.einsum("kbw,bwk->bw", x, weights[gate])
            times = np.broadcast_to(n[part], gate.shape)
            if learning:
                miss = times * (1 - _squash(dot))
                much = np.bincount(gate.ravel(), times.ravel(), len(weights))
                for k in range(KINDS):
                    weights[:, k] += RATE * np.bincount(gate.ravel(), (miss * x[k]).ravel(), len(weights)) / np.maximum(much, 1e-9)
            else:
                one, prefix = _bits(packed[part])
                low, share = _cells(np.where(one == 1, dot, -dot))
                for cell, rate in ((low, 1 - share), (low + 1, share)):
                    where = (prefix * CELLS + cell).ravel()
                    sums[0] += np.bincount(where, (times * rate * one).ravel(), 256 * CELLS)
                    sums[1] += np.bincount(where, (times * rate).ravel(), 256 * CELLS)
    return weights, sums


def refined(sums: np.ndarray, least: float = 16.0) -> np.ndarray:
    """The map [256, CELLS]: the share of ones by byte so far and mixed prediction, drawn to the prediction itself where little was seen."""
    plain = np.tile(_squash(np.arange(CELLS) * (24 / (CELLS - 1)) - 12), 256)
    return np.clip((sums[0] + least * plain) / (sums[1] + least), 1e-6, 1 - 1e-6).reshape(256, CELLS)


def costs(packed: np.ndarray, levels: np.ndarray, weights: np.ndarray, adapted: np.ndarray) -> np.ndarray:
    """log10 of the probability of each window's last byte."""
    out = np.empty(len(packed))
    for at in range(0, len(packed), 16 * BATCH):
        part = slice(at, at + 16 * BATCH)
        x, gate = _inputs(levels[:, :, part])
        dot = np.einsum("kbw,bwk->bw", x, weights[gate])
        one, prefix = _bits(packed[part])
        low, share = _cells(np.where(one == 1, dot, -dot))
        p = adapted[prefix, low] * (1 - share) + adapted[prefix, low + 1] * share
        p = 0.5 * _squash(dot) + 0.5 * np.where(one == 1, p, 1 - p)
        out[part] = np.log10(np.clip(p, 1e-9, 1 - 1e-9)).sum(axis=0)
    return out


class _Counts:
    """Numbers by key, handed on when more than HELD keys are held."""

    def __init__(self, kind: int):
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> list[pa.RecordBatch]:
        self.parts.append((keys, n))
        self.size += len(keys)
        if self.size <= 2 * HELD:
            return []
        self._merge()
        return self.rest() if self.size > HELD else []

    def _merge(self) -> None:
        codes, keys = pd.factorize(np.concatenate([p[0] for p in self.parts]))
        self.parts = [(keys, np.bincount(codes, np.concatenate([p[1] for p in self.parts]), len(keys)).astype(np.int64))]
        self.size = len(keys)

    def rest(self) -> list[pa.RecordBatch]:
        if not self.parts:
            return []
        self._merge()
        (keys, n), self.parts, self.size = self.parts[0], [], 0
        step = 1 << 16
        return [pa.RecordBatch.from_arrays([pa.array(np.full(len(keys[a : a + step]), self.kind, np.int8)), pa.array(keys[a : a + step]), pa.array(n[a : a + step])], names=["kind", "key", "n"]) for a in range(0, len(keys), step)]


def _count(batches):
    """Words (kind 0) and windows (kind 1) with their numbers in training texts; windows of other texts have the number 0."""
    both = _Counts(0), _Counts(1)
    for batch in chunks(batches):
        texts = texts_of(batch)
        trains = ~np.asarray(batch.column(batch.schema.get_field_index("held_out")))
        hashes, _, _, owner = words([t.lower() for t in texts])
        codes, kinds = pd.factorize(hashes[trains[owner]].view(np.int64))
        yield from both[0].add(np.append(kinds, END), np.append(np.bincount(codes, minlength=len(kinds)), trains.sum()))
        packed, owner = windows(texts)
        codes, kinds = pd.factorize(packed)
        yield from both[1].add(kinds, np.bincount(codes, trains[owner], len(kinds)).astype(np.int64))
    for counts in both:
        yield from counts.rest()


def _all(batches) -> tuple[np.ndarray, np.ndarray]:
    found = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, n = (np.concatenate([f[i] for f in found]) for i in range(2))
    order = np.argsort(keys)  # rows come in any order; results mustn't depend on it
    return keys[order], n[order]


def _learner(shared):
    """Of a task's windows (key, n): rows (place, value, times) of its weights, then of the sums for the map."""

    def run(batches):
        packed, n = _all(batches)
        if not n.any():
            return
        weights, sums = learn(packed, n, seen(packed, n, shared.value))
        place = np.arange(weights.size + sums.size)
        times = np.concatenate((np.full(weights.size, float(n.sum())), np.ones(sums.size)))
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(np.concatenate((weights.ravel(), sums.ravel()))), pa.array(times)], names=["place", "value", "times"])

    return run


def _coster(shared, model):
    def run(batches):
        packed, n = _all(batches)
        if len(n):
            cost = costs(packed, seen(packed, n, shared.value), *model.value)
            yield pa.RecordBatch.from_arrays([pa.array(packed), pa.array(cost), pa.array(n)], names=["key", "cost", "n"])

    return run


def _looked_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(value or 0, found) of each key in a table sorted by key."""
    if not len(table[0]):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    order = np.argsort(keys)  # neighbours in the table one after the other
    at = np.empty(len(keys), np.int64)
    at[order] = np.searchsorted(table[0], keys[order])
    at = np.minimum(at, len(table[0]) - 1)
    found = table[0][at] == keys
    return np.where(found, table[1][at], 0.0), found


_REST = pa.list_(pa.struct([("h", pa.int64()), ("n", pa.int64())]))


def _loose(n_texts: int, owner: np.ndarray, codes: np.ndarray, kinds: np.ndarray) -> pa.Array:
    """For each text its keys (places in kinds) and how often it holds each."""
    pairs, n = np.unique(owner * max(1, len(kinds)) + codes, return_counts=True)
    texts, codes = np.divmod(pairs, max(1, len(kinds)))
    ends = np.concatenate(([0], np.cumsum(np.bincount(texts, minlength=n_texts)))).astype(np.int32)
    items = pa.StructArray.from_arrays([pa.array(kinds[codes]), pa.array(n)], fields=list(_REST.value_type))
    return pa.ListArray.from_arrays(pa.array(ends), items)


def _scores(shared):
    def run(batches):
        top_words, top_windows, all_words, all_windows = shared.value
        for batch in chunks(batches):
            texts = texts_of(batch)
            hashes, _, _, owner = words([t.lower() for t in texts])
            codes, kinds = pd.factorize(hashes.view(np.int64))
            gain, found = _looked_up(kinds, top_words)
            n = np.bincount(owner, minlength=len(texts))
            base = np.bincount(owner, gain[codes], minlength=len(texts)).astype(np.float64)
            known = np.bincount(owner, found[codes], minlength=len(texts)).astype(np.int64)
            loose = np.flatnonzero(~found[codes]) if not all_words else np.zeros(0, np.int64)
            rest = _loose(len(texts), owner[loose], codes[loose], kinds)
            packed, own = windows(texts)
            codes, kinds = pd.factorize(packed)
            cost, found = _looked_up(kinds, top_windows)
            score = np.bincount(own, cost[codes], minlength=len(texts))
            loose = np.flatnonzero(~found[codes]) if not all_windows else np.zeros(0, np.int64)
            rest2 = _loose(len(texts), own[loose], codes[loose], kinds)
            sizes = np.array([len(t) + 1 for t in texts])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n + 1), pa.array(sizes), pa.array(base), pa.array(known), pa.array(score), rest, rest2], names=["doc_id", "n_tokens", "bytes", "top_sum", "top_known", "top_score", "rest", "rest2"])

    return run


def _top(rows: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Rows (n, ...) with the largest n, at most `most` of them, and how many there are in all. Found from a histogram of n in steps of an eighth of a power of two, without an order over all."""
    step = F.floor(F.log2("n") * 8)
    sizes = sorted(rows.groupBy(step.alias("step")).agg(F.count("*").alias("k")).collect(), reverse=True)  # 8 * 64 rows at most
    total, least = 0, None
    for r in sizes:
        total += r["k"]
        if total > most:
            break
        least = r["step"]
    return rows.where(step >= least) if least is not None else rows.where("false"), sum(r["k"] for r in sizes)


def _sorted(df: DataFrame, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
    table = df.select(key, value).toArrow()
    keys, values = np.asarray(table.column(0)), np.asarray(table.column(1))
    order = np.argsort(keys)
    return keys[order], values[order]


def model(counted: DataFrame) -> DataFrame:
    """Costs (key, cost, n) of all windows (key, n)."""
    spark = counted.sparkSession
    low = lambda order: F.col("key").bitwiseAND(F.lit((1 << 8 * (order + 1)) - 1))
    # windows of SPLIT + 1 bytes: at most 256**(SPLIT + 1) rows, whatever the corpus, and far fewer in any script
    short = _sorted(counted.groupBy(low(SPLIT).alias("key")).agg(F.sum("n").alias("n")), "key", "n")
    shared = spark.sparkContext.broadcast((short[0].view(np.uint64), short[1]))
    size = counted.count()
    dealt = counted.repartition(max(1, -(-size // PART)), F.shiftright(low(SPLIT + 1), 8))
    learned = map_arrow(dealt, _learner(shared), "place long, value double, times double")
    mean = learned.groupBy("place").agg(F.sum(F.col("value") * F.col("times")).alias("value"), F.sum("times").alias("times")).toArrow().to_pandas()  # weights and cells: a fixed number
    n = 8 * LEVELS * LEVELS * KINDS
    weights, sums = np.full(n, FIRST), np.zeros(2 * 256 * CELLS)
    own = mean["place"] < n
    weights[mean["place"][own]] = mean["value"][own] / mean["times"][own]
    sums[mean["place"][~own] - n] = mean["value"][~own]
    learned_model = spark.sparkContext.broadcast((weights.reshape(-1, KINDS), refined(sums.reshape(2, -1))))
    return map_arrow(dealt, _coster(shared, learned_model), "key long, cost double, n long")


def score(docs: DataFrame, held_out) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for each row of docs. held_out: a condition on docs; null counts as false."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    docs = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    counted = Stash(map_arrow(docs.select("text", "held_out"), _count, "kind byte, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    tokens = counted.read().where("kind = 0 and n > 0").select("key", "n")
    total = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    common, n_words = _top(tokens, TOP)
    keys, counts = _sorted(common, "key", "n")

    cost = Stash(model(counted.read().where("kind = 1").select("key", "n")))
    # windows without an occurrence in training count as seen once here
    usual, n_windows = _top(cost.read().withColumn("n", F.greatest("n", F.lit(1))), TOP)
    usual = _sorted(usual, "key", "cost")
    shared = spark.sparkContext.broadcast(((keys, np.log10(counts.astype(np.float64) + 1)), usual, len(keys) == n_words, len(usual[0]) == n_windows))

    schema = f"doc_id {kind}, n_tokens long, bytes long, top_sum double, top_known long, top_score double, rest array<struct<h:long,n:long>>, rest2 array<struct<h:long,n:long>>"
    rows = Stash(map_arrow(docs.select("doc_id", "text"), _scores(shared), schema).withColumn("row", F.monotonically_increasing_id()))
    whole = rows.read().drop("rest", "rest2")
    gain = F.col("top_sum")
    known, total_cost = F.col("top_known"), F.col("top_score")
    if len(keys) < n_words:
        more = rows.read().select("row", F.inline("rest")).join(tokens.withColumnRenamed("n", "c"), F.col("h") == F.col("key"))
        more = more.groupBy("row").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_sum"), F.sum("n").alias("more_known"))
        whole = whole.join(more, "row", "left")
        gain, known = gain + F.coalesce("more_sum", F.lit(0.0)), known + F.coalesce("more_known", F.lit(0))
    if len(usual[0]) < n_windows:
        more = rows.read().select("row", F.inline("rest2")).join(cost.read().select("key", "cost"), F.col("h") == F.col("key"))
        whole = whole.join(more.groupBy("row").agg(F.sum(F.col("n") * F.col("cost")).alias("more_score")), "row", "left")
        total_cost = total_cost + F.coalesce("more_score", F.lit(0.0))
    ends = tokens.where(F.col("key") == END).first()
    floor = math.log10(total["n"] + total["v"] + 1)
    out = whole.withColumns({
        "base_score": gain + F.lit(math.log10((ends["n"] if ends else 0) + 1)) - F.col("n_tokens") * F.lit(floor),
        "n_known": (known + F.lit(1 if total["n"] else 0)).cast("long"), "train_tokens": F.lit(int(total["n"])).cast("long"),
        "score": total_cost, "bits_per_byte": -total_cost / math.log10(2) / F.col("bytes"),
    })
    return out.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
