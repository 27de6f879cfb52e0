"""Whitening of embeddings by a tall-skinny QR, without a covariance matrix.

Vectors become integers, floor(256 * c) of each component. The fit list holds each distinct integer vector once. Its sums per
dimension are exact, so a row centred by them, (n * x - S) / n, has one rounding. Each task folds its centred rows into an upper triangle
R by QR decompositions; the tasks' triangles are merged FAN at a time, level by level, until one is left for each length of
vectors. If R = U s Vt, the covariance of the fit list is V (s * s / n) Vt, so V whitens, and small variances keep the
digits that forming the covariance would square away.

Rows then meet the model (one record per length of vectors) in map-only passes. The whitened fit list's covariance is
taken from sums of products, and the identity subtracted.

Defined results: vectors that are null, empty or hold a null or a non-finite component take no part. A null id passes through;
repeated rows get the same numbers each and count once in the fit list. Vectors of different lengths are fitted apart from each
other. Components whose deviation is 0 to within rounding (fewer distinct vectors than dimensions, constant
dimensions) can't be scaled to 1 and are left out, so a length with one distinct vector gives no rows. Finite components of any
size count up to 64 bits of floor(256 * c), where they are cut off; a deviation beyond 64 bits is given as the largest
64-bit number. An empty table gives no rows. Other columns are not read.

What goes to the driver grows with the square of the vectors' length (the last triangle), not with their number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm._spark import Stash, map_arrow

SCALE = 256
#: Triangles that one task merges at a time, rows that it adds to its triangle at a time.
FAN, BLOCK = 16, 4096
#: Share of the largest singular value below which one is taken for rounding.
LEAST = 1e-11
_LARGEST = (1 << 63) - 1


@dataclass
class Model:
    """Of vectors of one length: n distinct ones, their sums, components as columns (by falling eigenvalue), eigenvalues, the sum of all eigenvalues."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    trace: float


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, x): rows that take part, with integer components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    doubles = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("c")).where("size(c) > 0").where(F.forall("c", finite))
    # ends of the 64-bit range that a double holds; the product of a large finite component may be infinite
    edge = float((1 << 63) - 1024)
    whole = F.transform("c", lambda c: F.floor(F.greatest(F.lit(-edge), F.least(F.lit(edge), c * SCALE))).cast("long"))
    return doubles.select("vec_id", F.size("c").alias("dim"), whole.alias("x"))


def _matrices(batches, column: str = "x"):
    """(dim, rows' places, matrix) for each length of vectors in each batch, BLOCK rows at most."""
    for batch in batches:
        if not batch.num_rows:
            continue
        dims = np.asarray(batch.column(batch.schema.get_field_index("dim")))
        cells = batch.column(batch.schema.get_field_index(column))
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            for at in range(0, len(own), BLOCK):
                rows = own[at : at + BLOCK]
                yield int(dim), rows, cells.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: as int64 where that holds it, else as Python integers."""
    most = max(int(x.max()), -int(x.min()), 0) * n + max(abs(s) for s in sums)
    if most < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n as doubles."""
    scaled = _scaled(x, n, sums)
    if scaled.dtype == object:
        return np.array([[a / n for a in row] for row in scaled], float)  # integers of any size divide with one rounding
    return scaled / n


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _folder(stats: dict[int, tuple[int, list[int]]]):
    """Each task's triangle for each length of vectors."""

    def run(batches):
        held: dict[int, np.ndarray] = {}
        for dim, _, x in _matrices(batches):
            rows = _centred(x, *stats[dim])
            held[dim] = _triangle(np.vstack((held[dim], rows)) if dim in held else rows)
        if held:
            context = TaskContext.get()
            part = context.partitionId() if context else 0
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([part] * len(held), pa.int64()), pa.array([np.ascontiguousarray(r).tobytes() for r in held.values()], pa.binary())], names=["dim", "part", "r"])

    return run


def _unpack(dim: int, packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, float).reshape(-1, dim)


def _merger(batches):
    """Merges triangles of the same length and part, which come one after the other."""
    key, held = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), pa.array([np.ascontiguousarray(held).tobytes()], pa.binary())], names=["dim", "part", "r"])

    for batch in batches:
        for dim, part, packed in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("dim", "part", "r")), strict=True):
            r = _unpack(dim, packed)
            if (dim, part) == key:
                held = _triangle(np.vstack((held, r)))
            else:
                if key is not None:
                    yield out()
                key, held = (dim, part), r
    if key is not None:
        yield out()


_TRIANGLES = "dim int, part long, r binary"


def _merged(triangles: Stash) -> DataFrame:
    """One triangle for each length of vectors."""
    while triangles.read().agg(F.max("part")).first()[0]:
        next_ = triangles.read().withColumn("part", F.floor(F.col("part") / FAN).cast("long"))
        next_ = next_.repartition("dim", "part").sortWithinPartitions("dim", "part")
        up = Stash(map_arrow(next_, _merger, _TRIANGLES))
        triangles.drop()
        triangles = up
    return triangles.read()


def _solve(n: int, sums: list[int], r: np.ndarray, k: int) -> Model:
    _, s, vt = np.linalg.svd(r, full_matrices=False)
    live = s > s[0] * LEAST
    keep = min(k, int(live.sum()))
    return Model(n, sums, vt[:keep].T.copy(), s[:keep] ** 2 / n, float((s**2).sum()) / n)


def fit(vectors: DataFrame, k: int = 4) -> tuple[dict[int, Model], Stash]:
    """A model with up to k components for each length of vectors, and the fit list (dim, x)."""
    return _fit(quantised(vectors), k)


def _fit(rows: DataFrame, k: int) -> tuple[dict[int, Model], Stash]:
    listed = Stash(rows.select("dim", "x").distinct())
    places = listed.read().select("dim", F.posexplode("x").alias("at", "c"))
    sums = places.groupBy("dim", "at").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("total"), F.count("*").alias("n"))
    stats: dict[int, tuple[int, list[int]]] = {}
    for row in sums.orderBy("dim", "at").collect():  # as many rows as the vectors have dimensions
        stats.setdefault(row["dim"], (row["n"], []))[1].append(int(row["total"]))
    if not stats:
        return {}, listed
    triangles = Stash(map_arrow(listed.read(), _folder(stats), _TRIANGLES))
    last = _merged(triangles).collect()
    return {t["dim"]: _solve(*stats[t["dim"]], _unpack(t["dim"], bytes(t["r"])), k) for t in last}, listed


def _whitened(model: Model, x: np.ndarray) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ model.components / np.sqrt(model.values)


def _moments(models: dict[int, Model]):
    """Each task's sums of whitened components and of their products, for each length of vectors."""

    def run(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for dim, _, x in _matrices(batches):
            w = _whitened(models[dim], x)
            one, two = w.sum(axis=0), w.T @ w
            if dim in held:
                one, two = held[dim][0] + one, held[dim][1] + two
            held[dim] = one, two
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([one.tolist() for one, _ in held.values()], pa.list_(pa.float64())), pa.array([two.ravel().tolist() for _, two in held.values()], pa.list_(pa.float64()))], names=["dim", "one", "two"])

    return run


def identity_errors(listed: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """For each length of vectors the largest absolute entry of the whitened fit list's covariance minus the identity."""
    sums = map_arrow(listed, _moments(models), "dim int, one array<double>, two array<double>")
    cells = sums.select("dim", F.posexplode(F.concat("one", "two")).alias("at", "v")).groupBy("dim", "at").agg(F.sum("v").alias("v"))
    found: dict[int, list[float]] = {}
    for row in cells.orderBy("dim", "at").collect():  # k + k * k numbers a length
        found.setdefault(row["dim"], []).append(row["v"])
    out = {}
    for dim, v in found.items():
        n, k = models[dim].n, len(models[dim].values)
        mean, second = np.array(v[:k]) / n, np.array(v[k:]).reshape(k, k) / n
        out[dim] = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0
    return out


def _deviations(model: Model, x: np.ndarray) -> list[int]:
    scaled = _scaled(x, model.n, model.sums)
    if scaled.dtype != object and scaled.size and int(np.abs(scaled).max()) ** 2 * scaled.shape[1] < 1 << 63:
        return (scaled * scaled).sum(axis=1).tolist()
    return [min(sum(int(a) * int(a) for a in row), _LARGEST) for row in scaled]


def _scorer(models: dict[int, Model], errors: dict[int, float]):
    def run(batches):
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("vec_id"))
            for dim, rows, x in _matrices([batch]):
                model = models[dim]
                k = len(model.values)
                if not k:
                    continue
                w, deviation = _whitened(model, x), _deviations(model, x)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(rows) * k, model.n, np.int64)),
                    pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))),
                    pa.array(w.ravel()),
                    pa.array(np.tile(model.values / model.trace, len(rows))),
                    pa.array(np.full(len(rows) * k, errors[dim])),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, k: int = 4) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for each row of vectors (vec_id, embedding) that takes part and each of up to k components."""
    rows = quantised(vectors)
    models, listed = _fit(rows, k)
    errors = identity_errors(listed.read(), models) if models else {}
    listed.drop()
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    return map_arrow(rows, _scorer(models, errors), f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
