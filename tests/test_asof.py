import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import asof


def match(t, rights, direction, strict, tolerance):
    """The right (time, value) that belongs to a time, by a look at each."""
    if t is None:
        return None
    back = max((r for r in rights if r[0] < t or r[0] == t and not strict), default=None)
    first = min((r[0] for r in rights if r[0] > t or r[0] == t and not strict), default=None)
    ahead = max((r for r in rights if r[0] == first), default=None)
    back, ahead = (None if r is None or tolerance is not None and abs(r[0] - t) > tolerance else r for r in (back, ahead))
    if direction == "backward":
        return back
    if direction == "forward":
        return ahead
    return min((r for r in (back, ahead) if r is not None), key=lambda r: (abs(r[0] - t), r[0] > t), default=None)


def rows_of(seed, n, keys, span):
    r = random.Random(seed)
    # one key holds half of all rows, one is null, some times are null and many are equal
    return [(r.choice([keys[0]] * len(keys) + keys), None if r.random() < 0.05 else r.randrange(span), i) for i in range(n)]


@pytest.mark.parametrize("direction, strict, tolerance, slice_rows", [("backward", False, None, 10**6), ("backward", True, 3, 20), ("forward", False, 2, 20), ("forward", True, None, 10), ("nearest", False, None, 15), ("nearest", True, 4, 15)])
def test_matches_against_a_look_at_each(spark, direction, strict, tolerance, slice_rows):
    keys = ["a", "b", "c", None]
    left, right = rows_of(1, 160, keys, 200), rows_of(2, 90, keys, 200)
    # a stretch of the large key without right rows, over several slices
    right = [x for x in right if not (x[0] == "a" and x[1] is not None and 60 <= x[1] < 140)]
    found = asof.asof_join(spark.createDataFrame(left, "k string, t long, id long"), spark.createDataFrame(right, "k string, u long, v long"), ["k"], "t", "u", ["u", "v"], direction, strict, tolerance, slice_rows=slice_rows).collect()
    wanted = {}
    for k, t, i in left:
        wanted[i] = match(t, [(u, v) for kk, u, v in right if kk == k and k is not None and u is not None], direction, strict, tolerance) or (None, None)
    assert {r.id: (r.u, r.v) for r in found} == wanted and len(found) == len(left)


def test_dates_timestamps_and_what_is_refused(spark):
    d = date(2024, 3, 1)
    left = spark.createDataFrame([(1, d), (1, d), (2, d)], "k int, day date")
    right = spark.createDataFrame([(1, d - timedelta(3), 5.0), (2, d - timedelta(9), 6.0)], "k int, seen date, price double")
    assert sorted(tuple(r) for r in asof.asof_join(left, right, ["k"], "day", "seen", ["price"], tolerance=5).select("k", "price").na.fill(-1.0).collect()) == [(1, 5.0), (1, 5.0), (2, -1.0)]
    at = datetime(2024, 3, 1, 12)
    left = spark.createDataFrame([(1, at)], "k int, ts timestamp")
    right = spark.createDataFrame([(1, at + timedelta(microseconds=2), "x"), (1, at + timedelta(microseconds=1), "y")], "k int, then timestamp, v string")
    assert asof.asof_join(left, right, ["k"], "ts", "then", ["v"], "forward", tolerance=1).first().v == "y"
    assert asof.asof_join(left, right, ["k"], "ts", "then", ["v"]).first().v is None
    assert asof.asof_join(left, right.where("false"), ["k"], "ts", "then", ["v"]).count() == 1
    assert asof.asof_join(left.where("false"), right, ["k"], "ts", "then", ["v"]).count() == 0
    for bad in ({"direction": "sideways"}, {"take": ["k"]}):
        with pytest.raises(ValueError):
            asof.asof_join(left, right, ["k"], "ts", "then", **({"take": ["v"]} | bad))
    with pytest.raises(ValueError):
        asof.asof_join(left.withColumn("ts", F.to_date("ts")), right, ["k"], "ts", "then", ["v"])


def test_a_large_key_is_split(spark):
    """Half of all rows have one key: no slice of it holds more than twice the wanted rows."""
    rows = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 500).alias("k"), F.col("id").alias("__t"))
    bounds = asof.slices(rows, ["k"], 500).collect()
    assert [b[0] for b in bounds] == [0] and len(bounds[0]["__bounds"]) >= 15
