"""As-of joins: each row of the left side with the row of the right side whose time is nearest in one direction, of the same key.

Both sides go through one union, one exchange and one pass of a sorted window: the last right row seen so far, or the first one still
to come. Keys that hold more than SLICE_ROWS rows are split into slices of time of about that many rows, so that no task
holds a whole key; what a slice knows at its end (its last right row; for the other direction its first one) is one row a
slice, which is carried over the key's slices and given to the rows that found nothing in their own.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BACKWARD, FORWARD, NEAREST = "backward", "forward", "nearest"
#: Rows of both sides that a slice of one key holds about, keys that are split at most, and slices of a key at most.
SLICE_ROWS, KEYS, MARKS = 100_000, 10_000, 512


def _whole(c: Column, kind: str) -> Column:
    """A time as a whole number: days, microseconds, or the number itself."""
    if kind == "date":
        return F.unix_date(c).cast("long")
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":  # by its own digits, whatever the session's zone
        second = F.hour(c) * 3600 + F.minute(c) * 60
        return (F.unix_date(c.cast("date")).cast("long") * 86_400 + second) * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")
    if kind in ("byte", "short", "integer", "long"):
        return c.cast("long")
    raise ValueError(f"as-of joins go over dates, timestamps or whole numbers, not {kind}")


def named(on: list[str]) -> list[Column]:
    return [F.col(k).alias(f"__k{i}") for i, k in enumerate(on)]


def same_keys(on: list[str]) -> Column:
    same = F.lit(True)
    for i, k in enumerate(on):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return same


def slices(rows: DataFrame, on: list[str], slice_rows: int) -> DataFrame:
    """(__k..., __bounds): for each key with more rows than a slice takes, the times at which its slices end, by approximate percentiles. At most KEYS keys have one, as a slice takes a KEYS-th of all rows at least."""
    counts = rows.groupBy(*on).agg(F.count("*").alias("__n"))
    total = counts.agg(F.greatest(F.lit(slice_rows), F.sum("__n") / KEYS).alias("__most"))  # one row
    large = F.broadcast(counts.join(F.broadcast(total)).where("__n > __most").select(*named(on), "__n", "__most"))
    # of the percentiles as many, evenly dealt, as make slices of about the wanted size
    marks = F.percentile_approx("__t", [i / MARKS for i in range(1, MARKS)], 10_000)
    step = F.greatest(F.lit(1), F.floor(float(MARKS) * F.col("__most") / F.col("__n"))).cast("int")
    names = [f"__k{i}" for i in range(len(on))]
    marked = rows.join(large, same_keys(on)).groupBy(*names, "__n", "__most").agg(marks.alias("__p"))
    return marked.select(*names, F.array_distinct(F.filter("__p", lambda p, i: (i + 1) % step == 0)).alias("__bounds"))


def asof_join(left: DataFrame, right: DataFrame, on: list[str], left_time: str, right_time: str, take: list[str], direction: str = BACKWARD, strict: bool = False, tolerance: int | None = None, order: list[str] = (), slice_rows: int = SLICE_ROWS) -> DataFrame:
    """left's rows, all of them, with `take` of the right row that matches (null where none does).

    A backward match is the latest right row of the same keys whose time isn't after the left one's, a forward match the
    earliest that isn't before, the nearest the closer of both (backward on ties). strict: equal times don't match. tolerance:
    largest distance, in days for dates, microseconds for timestamps, else in the times' own unit. Of right rows with one key and time the
    largest by `order`, then by `take`, is used. Rows without a time or with a null key match nothing. Repeated left rows stay.
    """
    if direction not in (BACKWARD, FORWARD, NEAREST):
        raise ValueError(f"no direction {direction}")
    kinds = [df.schema[c].dataType.typeName() for df, c in ((left, left_time), (right, right_time))]
    if ("date" in kinds) != (kinds[0] == kinds[1] == "date"):
        raise ValueError("both times must be dates, or neither")
    clash = [c for c in take if c in left.columns]
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(clash)}")
    own = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    no_own = F.lit(None).cast(left.select(own.alias("o")).schema["o"].dataType)
    taken = F.struct(_whole(F.col(right_time), kinds[1]).alias("__t"), *(F.col(f"`{c}`") for c in take))
    ranked = F.struct(_whole(F.col(right_time), kinds[1]).alias("__t"), *(F.col(c) for c in order), *(F.col(f"`{c}`") for c in take if c not in order))
    whole_keys = [F.col(k).isNotNull() for k in on]
    best = right.where(reduce(and_, whole_keys, F.col(right_time).isNotNull())).groupBy(*(F.col(k).alias(k) for k in on), _whole(F.col(right_time), kinds[1]).alias("__t")).agg(F.max_by(taken, ranked).alias("__r"))
    no_right = F.lit(None).cast(best.schema["__r"].dataType)
    held = left.select(*(F.col(k) for k in on), _whole(F.col(left_time), kinds[0]).alias("__t"), own.alias("__l"), no_right.alias("__r"))
    both = held.unionByName(best.select(*on, "__t", no_own.alias("__l"), "__r"))

    bounds = F.broadcast(slices(both.where("__t is not null"), on, slice_rows))
    slice_ = F.when(F.col("__bounds").isNull() | F.col("__t").isNull(), 0).otherwise(F.size(F.filter("__bounds", lambda x: x < F.col("__t")))).cast("int")
    placed = lambda how: both.join(bounds, same_keys(on), how).select(*on, "__t", "__l", "__r", slice_.alias("__s"))

    # of equal times the right row stands so that the left one sees it, or doesn't
    is_left = F.col("__l").isNotNull()
    whole = Window.partitionBy(*on, "__s")
    ways = [w for w in (BACKWARD, FORWARD) if direction in (w, NEAREST)]
    rows = placed("left")
    for way in ways:
        seen_last = is_left.cast("int") if not strict else (~is_left).cast("int")
        by = [F.col("__t").asc_nulls_first(), seen_last] if way == BACKWARD else [F.col("__t").desc_nulls_first(), seen_last]
        run = whole.orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn(f"__{way}", F.last("__r", ignorenulls=True).over(run))
    for way in ways:
        rows = _carried(rows, placed("inner"), on, way)
    found = {w: F.when(F.col("__t").isNotNull(), F.col(f"__{w}")) for w in ways}
    if tolerance is not None:
        found = {w: F.when(F.abs(F.col("__t") - c["__t"]) <= tolerance, c) for w, c in found.items()}
    if direction == NEAREST:
        back, ahead = found[BACKWARD], found[FORWARD]
        hit = F.when(ahead.isNull() | (F.col("__t") - back["__t"] <= ahead["__t"] - F.col("__t")), back).otherwise(ahead)
    else:
        hit = found[direction]
    out = rows.where(is_left).select("__l", hit.alias("__hit"))
    return out.select(*(F.col("__l")[c].alias(c) for c in left.columns), *(F.col("__hit")[c].alias(c) for c in take))


def _carried(rows: DataFrame, split: DataFrame, on: list[str], way: str) -> DataFrame:
    """Rows of later slices (of earlier ones, looking forward) that found nothing in their own get the nearest right row of the slices before. split: the rows of keys that have slices."""
    edge = F.max_by if way == BACKWARD else F.min_by
    ends = split.groupBy(*on, "__s").agg(edge("__r", F.when(F.col("__r").isNotNull(), F.col("__t"))).alias("__edge"))
    slices = Window.partitionBy(*on).orderBy("__s" if way == BACKWARD else F.desc("__s")).rowsBetween(Window.unboundedPreceding, -1)
    given = ends.withColumn("__given", F.last("__edge", ignorenulls=True).over(slices)).where("__given is not null")
    # one row for each slice of a key that has some: 2 * KEYS at most
    small = F.broadcast(given.select(*named(on), F.col("__s").alias("__es"), "__given"))
    joined = rows.join(small, same_keys(on) & (F.col("__s") == F.col("__es")), "left")
    return joined.withColumn(f"__{way}", F.coalesce(f"__{way}", "__given")).drop("__given", "__es", *(f"__k{i}" for i in range(len(on))))
