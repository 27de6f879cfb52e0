"""Packing documents into sequences of at most WINDOW tokens by non-negative least squares over a length histogram.

Texts become token ids of a public byte-level BPE vocabulary (read with its rank file, which gives the same ids as the
JSON file several times faster) and one id 0. Each document is cut into full windows, which are sequences of their own, and a
rest. Rests are binned by length, upwards, in steps of STEP; all ways to fill a window with up to DEPTH bins are columns of
a matrix, and non-negative least squares finds how often to repeat each so that the histogram is met. Repeats are rounded
down to what there is, and what is left is packed greedily, longest first, again as counts.

Only the histogram (WINDOW / STEP numbers) and the plan (ranges of ranks for each bin) are on the driver. Rests are ranked
within their bin by hash buckets and running totals, so no task holds a bin, and a plan's range gives each rank its sequence.

Defined results: a null text is like an empty one, one token. A null doc_id passes through. Repeated rows are packed each.
Runs of white space of any length are tokens like others.
An empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import base64
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._spark import Stash, chunks, map_arrow, sized, texts_of

WINDOW, STEP, DEPTH = 1024, 8, 3
VOCABULARY, JSON = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
END_OF_TEXT = ("<|endoftext|>", 50256)
#: Rests that one hash bucket holds about.
BUCKET = 20_000


@cache
def _encoder(vocabulary: str):
    import public_tokenizers
    import tiktoken

    ranks = {}
    with open(public_tokenizers.path(vocabulary), "rb") as f:  # part of an installed Python package, not an input
        for line in f:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return tiktoken.Encoding("corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=dict([END_OF_TEXT]))


@cache
def _json_tokenizer(vocabulary: str):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def token_ids(text: bytes, vocabulary: str = VOCABULARY, json_vocabulary: str = JSON) -> np.ndarray:
    """uint32 ids of a text, with the closing 0. END_OF_TEXT in a text is its own id, as the JSON tokenizer has it. That tokenizer itself reads a text whose white space runs on for longer than the quick one's stack allows."""
    enc = _encoder(vocabulary)
    s = text.decode("utf-8", "replace")
    try:
        out = enc.encode(s, allowed_special="all") if END_OF_TEXT[0] in s else enc.encode_ordinary(s)
    except BaseException as e:  # the library's panic is no Exception, and its class can't be imported
        if type(e).__name__ != "PanicException":
            raise
        out = _json_tokenizer(json_vocabulary).encode(s, add_special_tokens=False).ids
    return np.array([*out, 0], dtype="<u4")


def _cutter(vocabulary: str):
    def run(batches):
        for batch in chunks(batches):
            ids, rows = batch.column(0).to_pylist(), []
            for doc, text in zip(ids, texts_of(batch), strict=True):
                tokens = token_ids(text, vocabulary)
                for at in range(0, len(tokens), WINDOW):
                    piece = tokens[at : at + WINDOW]
                    rows.append((doc, at, len(piece), zlib.crc32(piece.tobytes()), len(tokens)))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], batch.column(0).type), *(pa.array(c, pa.int64()) for c in cols[1:])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 with the least |a x - b|, by an active set: the column with the steepest descent joins, columns that would go below 0 leave."""
    gram, target = a.T @ a, a.T @ b
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    slack = 1e-9 * max(1.0, np.abs(target).max())
    for _ in range(rounds):
        descent = np.where(active, -np.inf, target - gram @ x)
        if active.all() or descent.max() <= slack:
            break
        active[descent.argmax()] = True
        while True:
            on = np.flatnonzero(active)
            best = np.zeros_like(x)
            best[on] = np.linalg.lstsq(a[:, on], b, rcond=None)[0]
            low = on[best[on] <= 0]
            if not len(low):
                break
            reach = min(x[i] / (x[i] - best[i]) if x[i] > best[i] else 0.0 for i in low)
            x = x + reach * (best - x)
            gone = active & (x <= 1e-12)
            gone |= np.isin(np.arange(len(x)), low) & (x <= 1e-9)
            if not gone.any():
                gone[low] = True
            active &= ~gone
            x[~active] = 0
            if not active.any():
                break
        x = np.where(active, np.maximum(best, 0), 0.0) if active.any() else x * 0
    return x


def fillings(bins: int, depth: int) -> list[tuple[int, ...]]:
    """All ways to write bins as a sum of up to depth numbers from 1 to bins, largest first."""
    out: list[tuple[int, ...]] = []

    def extend(rest, most, parts):
        if rest == 0:
            out.append(parts)
        elif len(parts) < depth:
            for p in range(min(rest, most), 0, -1):
                if p * (depth - len(parts)) >= rest:
                    extend(rest - p, p, (*parts, p))

    extend(bins, bins, ())
    return out


def plan(histogram: dict[int, int], bins: int = WINDOW // STEP, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(combination of bins, how often): together exactly the histogram, each combination at most `bins`."""
    left = np.zeros(bins + 1, np.int64)
    for k, n in histogram.items():
        left[k] = n
    out = []
    ways = [w for w in fillings(bins, depth) if all(left[p] for p in w)]
    if ways:
        a = np.zeros((bins, len(ways)))
        for i, w in enumerate(ways):
            for p in w:
                a[p - 1, i] += 1
        x = nnls(a, left[1:].astype(float))
        for i in np.argsort(-x, kind="stable"):
            need = np.bincount(ways[i], minlength=bins + 1)
            n = min(int(round(x[i])), *(int(left[p] // need[p]) for p in set(ways[i])))
            if n > 0:
                out.append((ways[i], n))
                left -= n * need
    while left.any():
        rest, parts = bins, []
        free = left.copy()
        while rest:
            fits = np.flatnonzero(free[: rest + 1])
            if not len(fits):
                break
            p = int(fits[-1])
            parts.append(p)
            free[p] -= 1
            rest -= p
        need = np.bincount(parts, minlength=bins + 1)
        n = min(int(left[p] // need[p]) for p in set(parts))
        out.append((tuple(parts), n))
        left -= n * need
    return out


def ranges(combos: list[tuple[tuple[int, ...], int]], first_sequence: int) -> list[tuple[int, int, int, int, int]]:
    """(bin, from rank, to rank, sequence of the first, slot)."""
    used: dict[int, int] = {}
    out, sequence = [], first_sequence
    for parts, n in combos:
        for slot, p in enumerate(parts):
            at = used.get(p, 0)
            out.append((p, at, at + n, sequence, slot))
            used[p] = at + n
        sequence += n
    return out


def pack(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for each piece of each row of docs."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    cut = map_arrow(docs.select("doc_id", "text"), _cutter(vocabulary), f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")
    pieces = Stash(cut.withColumn("bin", F.ceil(F.col("length") / STEP).cast("int")).withColumn("bin", F.when(F.col("length") == WINDOW, 0).otherwise(F.col("bin"))))
    histogram = {r["bin"]: r["n"] for r in pieces.read().groupBy("bin").agg(F.count("*").alias("n")).collect()}  # WINDOW / STEP + 1 rows at most
    total, full = sum(histogram.values()), histogram.pop(0, 0)
    buckets = max(1, -(-total // BUCKET))
    spread = pieces.read().withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    own = Window.partitionBy("bucket", "bin").orderBy("doc_id", "start", "ids_crc32")
    ranked = Stash(spread.withColumn("own", F.row_number().over(own).cast("long") - 1))
    before = Window.partitionBy("bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranked.read().groupBy("bin", "bucket").agg(F.count("*").alias("n")).select("bin", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    counts = Stash(counts)
    rank = ranked.read().join(sized(counts.read()), ["bin", "bucket"]).withColumn("rank", F.col("before") + F.col("own")).drop("bucket", "own", "before")
    table = [(0, 0, full, 0, 0), *ranges(plan(histogram), full)]
    # the plan has at most a few ranges for each of the WINDOW / STEP bins, whatever the corpus
    slots = F.broadcast(spark.createDataFrame(table, "b int, lo long, hi long, sequence long, slot int"))
    placed = rank.join(slots, (F.col("bin") == F.col("b")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    placed = placed.withColumn("sequence_id", F.col("sequence") + F.col("rank") - F.col("lo"))
    along = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    out = placed.withColumn("offset", F.coalesce(F.sum("length").over(along), F.lit(0)))
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
