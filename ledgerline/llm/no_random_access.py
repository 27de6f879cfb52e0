"""Exact top-k by inner product, by sorted lists that are read in order only.

Vectors become integers, floor(1024 * x) of each component. Each dimension is a list. The vectors of a slot come by falling
length, one block after another, and a block's lists are read in the order of their spread. A list that hasn't been read
lies between its two ends, and the unread part of a vector is no longer than its remaining length; both bound a vector's score
from above. The k-th best score so far bounds the k-th best of all from below. A query passes over a block whose lists' ends
and longest vector cannot reach that score; in the other blocks vectors that cannot reach it after a share of the lists are left out,
and the scores of the others are resolved exactly. Sums are carried on from share to share, so that a block costs at most one
product of matrices. A few queries tell for each slot whether reading a share first leaves out enough to pay.

Every query meets all vectors of a slot: rows are dealt over slots by their place in the table, so that repeated rows spread
evenly, and each set of at most QUERIES queries goes to every slot. A task holds one set of queries and one block of BLOCK vectors,
and leaves k rows a query; a second step keeps each query's best.

Defined results: vectors that are null, empty or hold a null or a non-finite component take no part, nor do rows
with a null id. Finite components of any size count; where sums leave the integers that float64 holds exactly, all scores are
resolved in 64-bit or longer integers, and a score beyond 64 bits is given as the nearest 64-bit number. Vectors meet only
queries of their own length. A query never meets rows with its own id. Repeated rows are queries and
candidates each. Ties go to the smaller id. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm._spark import Stash, map_arrow

SCALE = 1024
#: Vectors of a block, the least number of vectors of a slot, and queries that a task holds at most.
BLOCK, SLOT, QUERIES = 2048, 8192, 32_768
#: Shares of the lists after which bounds may be taken, and queries that tell which share pays.
SHARES, PROBES = (0.125, 0.25, 0.5), 8
#: A share pays if at most so much of its pairs stay open; pairs below FEW of all are resolved one by one.
PAYS, FEW = 0.05, 0.02
#: Vectors with larger components are read apart from the others.
COMMON = float(1 << 20)
#: Products that are held at once.
AT_ONCE = 1 << 20
_LARGEST = (1 << 63) - 1


def whole(x: np.ndarray) -> np.ndarray:
    """floor(1024 * x) as int64 where that holds them all, else as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(x * SCALE)
    if not x.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([[int(a) if np.isfinite(a) else int(b) * SCALE for a, b in zip(r, s, strict=True)] for r, s in zip(scaled, x, strict=True)], dtype=object)


def _reach(v: np.ndarray) -> int:
    return int(abs(v).max()) if v.size else 0


def _read(share: float, n: int) -> int:
    return max(1, int(n * share))


def _lengths(x: np.ndarray) -> np.ndarray:
    """Lengths of rows, rounded up."""
    return np.sqrt(np.einsum("ij,ij->i", x, x)) * (1 + 1e-9)


def _ends(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For each query the most that a vector between the lists' ends can score."""
    return np.maximum(q, 0) @ high + np.minimum(q, 0) @ low


class Best:
    """The k best vectors so far for each query (rows of queries, with their ids)."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.floor = np.full(len(ids), -np.inf)
        self.share = None
        self.query, self.score, self.vector = (np.zeros(0, np.int64) for _ in range(3))
        common = np.abs(queries).max(axis=1) < COMMON / SCALE if len(ids) else np.zeros(0, bool)
        self.parts = [(at, whole(queries[at])) for at in (np.flatnonzero(common), np.flatnonzero(~common)) if len(at)]

    def read(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Takes a block of vectors into account."""
        common = np.abs(vectors).max(axis=1) < COMMON / SCALE
        for rows in (np.flatnonzero(common), np.flatnonzero(~common)):
            if not len(rows):
                continue
            v = whole(vectors[rows])
            for asks, q in self.parts:
                # a set of queries whose products with the block fit in memory
                step = max(1, AT_ONCE // len(rows))
                for at in range(0, len(asks), step):
                    self._meet(ids[rows], v, asks[at : at + step], q[at : at + step])

    def _meet(self, ids: np.ndarray, v: np.ndarray, asks: np.ndarray, q: np.ndarray) -> None:
        sums = _reach(v) * _reach(q) * v.shape[1]
        if sums < 1 << 53:
            self._bounded(ids, v.astype(np.float64), asks, q.astype(np.float64))
            return
        # bounds would not be exact
        i, j = np.nonzero(ids[:, None] != self.ids[asks][None, :])
        score = v @ q.T if sums < 1 << 62 else np.clip(v.astype(object) @ q.T.astype(object), -_LARGEST, _LARGEST).astype(np.int64)
        self._keep(asks[j], score[i, j], ids[i])

    def _bounded(self, ids: np.ndarray, v: np.ndarray, asks: np.ndarray, q: np.ndarray) -> None:
        """A block whose sums float64 holds exactly."""
        ends = v.min(axis=0), v.max(axis=0)
        reach = np.minimum(_ends(q, *ends), _lengths(q) * _lengths(v).max())
        going = np.flatnonzero(reach >= self.floor[asks])
        if not len(going):
            return
        asks, q = asks[going], q[going]
        floor = self.floor[asks]
        lists = np.argsort(ends[0] - ends[1], kind="stable")
        known = np.isfinite(floor)
        if known.all():
            if self.share is None:
                few = np.linspace(0, len(asks) - 1, min(PROBES, len(asks))).astype(int)
                left = {s: np.mean(self._after(s, lists, v, q[few], ends)[1] >= floor[few, None]) for s in SHARES}
                self.share = next((s for s in SHARES if left[s] <= PAYS), 1.0)
            if self.share < 1:
                part, upper = self._after(self.share, lists, v, q, ends)
                open_ = upper >= floor[:, None]
                n = np.count_nonzero(open_)
                if n <= FEW * open_.size:
                    j, i = np.nonzero(open_)
                    other = ids[i] != self.ids[asks[j]]
                    i, j = i[other], j[other]
                    score = np.concatenate([np.zeros(0), *(np.einsum("ij,ij->i", v[i[a : a + 20_000]], q[j[a : a + 20_000]]) for a in range(0, len(i), 20_000))])
                    self._keep(asks[j], score.astype(np.int64), ids[i])
                    return
                some = np.flatnonzero(open_.any(axis=0))
                rest = lists[_read(self.share, len(lists)) :]
                ids, score = ids[some], part[:, some] + q[:, rest] @ v[some][:, rest].T
            else:
                score = q @ v.T
        else:
            score = q @ v.T
        for i in np.flatnonzero(np.isin(ids, self.ids[asks])):
            score[self.ids[asks] == ids[i], i] = -np.inf
        if not known.all() and score.shape[1] >= self.k:
            new = np.flatnonzero(~known)
            floor[new] = np.partition(score[new], score.shape[1] - self.k, axis=1)[:, score.shape[1] - self.k]
        j, i = np.divmod(np.flatnonzero((score >= floor[:, None]) & (score > -np.inf)), score.shape[1])
        self._keep(asks[j], score[j, i].astype(np.int64), ids[i])

    @staticmethod
    def _after(share: float, lists: np.ndarray, v: np.ndarray, q: np.ndarray, ends: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """[queries, vectors]: the sums over a share of the lists, and the most that scores can be."""
        at = _read(share, len(lists))
        read, rest = lists[:at], lists[at:]
        part = q[:, read] @ v[:, read].T
        others = q[:, rest]
        most = np.minimum(np.outer(_lengths(others), _lengths(v[:, rest])), _ends(others, ends[0][rest], ends[1][rest])[:, None])
        return part, part + most

    def _keep(self, query: np.ndarray, score: np.ndarray, vector: np.ndarray) -> None:
        query, score, vector = np.concatenate((self.query, query)), np.concatenate((self.score, score)), np.concatenate((self.vector, vector))
        order = np.lexsort((vector, -score, query))
        query, score, vector = query[order], score[order], vector[order]
        count = np.bincount(query, minlength=len(self.ids))
        rank = np.arange(len(query)) - (np.cumsum(count) - count)[query]
        kept = rank < self.k
        self.query, self.score, self.vector = query[kept], score[kept], vector[kept]
        last = rank == self.k - 1
        self.floor[query[last]] = score[last]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _search(k: int):
    """Rows in order of key and kind: for each key the queries (kind 0), then the vectors (kind 1)."""

    def run(batches):
        key, asks, held, waiting, best = None, [], [], 0, None

        def read():
            nonlocal best, held, waiting
            if best is None:
                best = Best(np.concatenate([a[0] for a in asks]), np.concatenate([a[2] for a in asks]), k) if asks else Best(np.zeros(0, np.int64), np.zeros((0, 1)), k)
            if held and len(best.ids):
                ids, vectors = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                for at in range(0, len(ids), BLOCK):
                    best.read(ids[at : at + BLOCK], vectors[at : at + BLOCK])
            held, waiting = [], 0

        def results():
            read()
            if len(best.query):
                ask = np.concatenate([a[1] for a in asks])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.ids[best.query], ask[best.query], best.vector, best.score)], names=["query_id", "row", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            col = lambda c, b=batch: np.asarray(b.column(b.schema.get_field_index(c)))
            dim, part, slot, kind, ids, rows = (col(c) for c in ("dim", "part", "slot", "kind", "vec_id", "row"))
            x = batch.column(batch.schema.get_field_index("x"))
            state = np.stack([dim, part, slot, kind])
            edges = [0, *(np.flatnonzero((state[:, 1:] != state[:, :-1]).any(axis=0)) + 1).tolist(), len(ids)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                here = (dim[a], part[a], slot[a])
                if here != key:
                    if key is not None:
                        yield from results()
                    key, asks, held, waiting, best = here, [], [], 0, None
                if kind[a] == 0:
                    asks.append((ids[a:b], rows[a:b], _matrix(x.slice(a, b - a))))
                else:
                    held.append((ids[a:b], _matrix(x.slice(a, b - a))))
                    waiting += b - a
                    if waiting >= BLOCK:
                        read()
        if key is not None:
            yield from results()

    return run


def taking_part(vectors: DataFrame) -> DataFrame:
    """(vec_id, x, dim): rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    doubles = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    return doubles.where("vec_id is not null and size(x) > 0").where(F.forall("x", finite)).withColumn("dim", F.size("x"))


def top_k(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of vectors (vec_id, embedding) whose id is divisible by `every`."""
    rows = Stash(taking_part(vectors).withColumn("row", F.monotonically_increasing_id()))
    is_query = F.col("vec_id") % every == 0
    sizes = rows.read().agg(F.count("*").alias("n"), F.count_if(is_query).alias("queries")).first()
    sets = max(1, -(-sizes["queries"] // QUERIES))
    # a slot has at least as many vectors as it gets queries, so that copies of queries don't outgrow the vectors
    slots = max(1, -(-sizes["n"] // max(SLOT, min(sizes["queries"], QUERIES))))
    dealt = lambda salt, count: F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(count)).cast("int")
    each = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    asks = rows.read().where(is_query).select("dim", dealt(1, sets).alias("part"), each(slots).alias("slot"), F.lit(0).alias("kind"), "vec_id", "row", "x")
    held = rows.read().select("dim", each(sets).alias("part"), dealt(2, slots).alias("slot"), F.lit(1).alias("kind"), "vec_id", "row", "x")
    length = F.aggregate("x", F.lit(0.0), lambda sum_, x: sum_ + x * x)
    key = ["dim", "part", "slot"]
    met = asks.unionByName(held).repartition(sets * slots, *key).sortWithinPartitions(*key, "kind", length.desc())
    found = map_arrow(met, _search(k), "query_id long, row long, vec_id long, score long")
    best = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The same in DuckDB.
SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS p FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.p) + 1), lambda i: q.p[i] * c.p[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.p) = len(c.p) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
