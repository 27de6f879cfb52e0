"""Quality scores by histogram gradient-boosted trees over statistics of a document's text.

Trees grow level by level on binned statistics and are flattened into arrays (statistic, threshold and leaf value by
heap position), so that a batch of documents descends all trees in numpy. The model is fitted on the driver from at most
`sample` labelled rows (the documented bound; those with the smallest hashes of their ids) and goes to the tasks as a few
kilobytes; scoring is one pass over the texts without a shuffle.

Defined results: a null text scores as an empty one; a null doc_id passes through with held_out false; repeated rows
score alike; without labelled rows every score is 0.5; with one class only, its smoothed share. Columns other than doc_id
and text are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm._hashing import words
from ledgerline.llm._spark import Stash, chunks, map_arrow, sized, texts_of

#: The most labelled rows that a model is fitted on.
SAMPLE = 20_000
TREES, DEPTH, BINS, SHRINK, LEAST, RIDGE = 80, 4, 64, 0.15, 8.0, 1.0
CUT = 0.7
#: Bytes of text whose statistics are taken at a time.
STEP = 1 << 18

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "symbol": b"#*$%&<>", "bar": b"|", "shout": b"!?",
    "stop": b".", "comma": b",;:", "other": b"\"'()[]{}+-/\\=_~^`@", "wide": bytes(range(0xC0, 0x100)), "line": b"\n",
}
FEATURES = [*_KINDS, "log_words", "mean_word", "long_words", "distinct_words", "repeats", "top_word", "short_words", "line_words", "dup_lines", "stopped_lines", "distinct_pairs"]


def statistics(texts: list[bytes]) -> np.ndarray:
    """float64 [texts, FEATURES]."""
    out = np.zeros((len(texts), len(FEATURES)))
    table = np.zeros((len(_KINDS), 256))
    for i, chars in enumerate(_KINDS.values()):
        table[i, list(chars)] = 1
    hashes, starts, ends, owner = words(texts)
    ends_at = np.cumsum(np.bincount(owner, minlength=len(texts)))
    for t, text in enumerate(texts):
        to = ends_at[t]
        own = hashes[ends_at[t - 1] if t else 0 : to]
        n = len(own)
        if not n:
            continue
        out[t, : len(_KINDS)] = table @ np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) / len(text)
        length = (ends - starts)[to - n : to]
        _, counts = np.unique(own, return_counts=True)
        lines = [x for x in (y.strip() for y in text.split(b"\n")) if x]
        pairs = own[1:] * np.uint64(3) ^ own[:-1]
        out[t, len(_KINDS) :] = (
            np.log1p(n), length.mean(), (length > 20).mean(), len(counts) / n, (own[1:] == own[:-1]).mean() if n > 1 else 0, counts.max() / n, (length <= 3).mean(),
            np.log1p(n / max(1, len(lines))), 1 - len(set(lines)) / max(1, len(lines)), sum(x[-1:] in b".!?" for x in lines) / max(1, len(lines)), len(np.unique(pairs)) / max(1, n - 1),
        )
    return out


def fit(x: np.ndarray, y: np.ndarray) -> dict:
    """start: log odds before the trees. feature, threshold [trees, inner nodes], leaf [trees, leaves]: right means above the threshold."""
    inner = 2**DEPTH - 1
    model = {"start": 0.0, "feature": np.zeros((0, inner), np.int64), "threshold": np.zeros((0, inner)), "leaf": np.zeros((0, 2**DEPTH))}
    if not len(y):
        return model
    share = (y.sum() + 0.5) / (len(y) + 1)
    model["start"] = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), model["start"])
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first = 2**depth - 1
            here = node - first
            best, at = np.full(2**depth, 1e-6), {}
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                cell = here * BINS + binned[:, f]
                g, h = (np.bincount(cell, w, minlength=2**depth * BINS).reshape(-1, BINS).cumsum(axis=1) for w in (grad, hess))
                gl, hl, ga, ha = g[:, : len(c)], h[:, : len(c)], g[:, -1:], h[:, -1:]
                gain = gl**2 / (hl + RIDGE) + (ga - gl) ** 2 / (ha - hl + RIDGE) - ga**2 / (ha + RIDGE)
                gain = np.where((hl >= LEAST / 16) & (ha - hl >= LEAST / 16), gain, -1)
                top = gain.argmax(axis=1)
                for k in np.flatnonzero(gain.max(axis=1) > best):
                    best[k], at[k] = gain[k, top[k]], (f, top[k])
            for k, (f, b) in at.items():
                feature[first + k], threshold[first + k] = f, cuts[f][b]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        at_leaf = node - inner
        g, h = (np.bincount(at_leaf, w, minlength=inner + 1) for w in (grad, hess))
        leaf = SHRINK * g / (h + RIDGE)
        margin += leaf[at_leaf]
        trees.append((feature, threshold, leaf))
    model["feature"], model["threshold"], model["leaf"] = (np.stack([t[i] for t in trees]) for i in range(3))
    return model


def predict(model: dict, x: np.ndarray) -> np.ndarray:
    """Probabilities of label 1."""
    total = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for feature, threshold, leaf in zip(model["feature"], model["threshold"], model["leaf"], strict=True):
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
        total += leaf[node - len(feature)]
    return 1 / (1 + np.exp(-total))


def held_out(n: int, part: int):
    """Whether crc32 of the doc_id as text leaves this remainder; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % n == part, F.lit(False))


def _features(batches):
    for batch in chunks(batches, size=STEP):
        x = statistics(texts_of(batch))
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """labels: (doc_id, label 0 or 1); docs: (doc_id, text). Fits on at most `sample` labelled rows whose document is there."""
    known = labels.select("doc_id", F.col("label").cast("double").alias("y")).where("doc_id is not null and y is not null")
    known = known.groupBy("doc_id").agg(F.round(F.avg("y")).alias("y"))
    # hashes below a share that holds about 1.2 times the sample, so that little is left to be put in order
    share = min(1.0, 1.2 * (sample + 100) / max(1, known.count()))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    known = Stash(known.where(draw <= int(share * (1 << 40))).orderBy(draw, "doc_id").limit(sample))
    # of several texts with one doc_id the smallest counts, so there are at most `sample` rows
    found = docs.select("doc_id", "text").join(sized(known.read()), "doc_id").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"), F.min("y").alias("y"))
    rows = map_arrow(found.select("doc_id", "y", "text"), _features, "doc_id string, y double, x array<double>").toArrow().to_pandas().sort_values("doc_id")
    if not len(rows):
        return fit(np.zeros((0, len(FEATURES))), np.zeros(0))
    return fit(np.stack(rows["x"].to_numpy()), rows["y"].to_numpy())


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) for each row of docs."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for batch in chunks(batches, size=STEP):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(predict(model, statistics(texts_of(batch))))], names=["doc_id", "score"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")
