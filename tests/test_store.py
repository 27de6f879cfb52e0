import pytest
from pyspark.sql import functions as F

from ledgerline.sources import store
from ledgerline.streaming.promote import promote

SCHEMA = "k string, v int"


def rows(spark, *r):
    return spark.createDataFrame(list(r), SCHEMA)


def test_raw_is_immutable(spark, tmp_path):
    store.write_raw(rows(spark, ("a", 1)), str(tmp_path), "p", "d", "r1")
    with pytest.raises(Exception, match="already exists"):
        store.write_raw(rows(spark, ("a", 1)), str(tmp_path), "p", "d", "r1")


def test_upsert_is_idempotent_and_incoming_wins(spark, tmp_path):
    t = str(tmp_path / "t")
    assert store.read_table(spark, t, SCHEMA).count() == 0
    store.upsert(rows(spark, ("a", 1), ("b", 1)), t, ["k"])
    for _ in range(2):
        store.upsert(rows(spark, ("b", 2), ("c", 3)), t, ["k"])
        assert sorted(map(tuple, store.read_table(spark, t).collect())) == [("a", 1), ("b", 2), ("c", 3)]
    assert store.upsert(rows(spark), t, ["k"])["rows_in"] == 0


def test_a_torn_write_leaves_the_old_version(spark, tmp_path):
    t = str(tmp_path / "t")
    store.upsert(rows(spark, ("a", 1)), t, ["k"])
    rows(spark, ("x", 9)).write.parquet(f"{t}/data/__v=torn")
    assert [tuple(r) for r in store.read_table(spark, t).collect()] == [("a", 1)]
    assert store.vacuum(spark, t) == 1 and [tuple(r) for r in store.read_table(spark, t).collect()] == [("a", 1)]


def test_untouched_partitions_stay_as_they_are(spark, tmp_path):
    t, schema = str(tmp_path / "t"), "k string, year int, v int"
    made = lambda *r: spark.createDataFrame(list(r), schema)
    assert store.upsert(made(("a", 2023, 1), ("b", 2024, 1), ("n", None, 1)), t, ["k"], "year") == {"rows_in": 3, "rows_new": 3, "rows_replaced": 0}
    first = store.current(spark, t)[1]["parts"]
    more = made(("b", 2024, 2), ("c", 2024, 1)).withColumn("extra", F.lit("x"))
    assert store.upsert(more, t, ["k"], "year") == {"rows_in": 2, "rows_new": 1, "rows_replaced": 1}
    second = store.current(spark, t)[1]["parts"]
    assert second["year=2023"] == first["year=2023"] and second["year=2024"] != first["year=2024"]
    assert {tuple(r) for r in store.read_table(spark, t).collect()} == {("a", 2023, 1, None), ("n", None, 1, None), ("b", 2024, 2, "x"), ("c", 2024, 1, "x")}
    assert store.upsert(made(("n", None, 5)), t, ["k"], "year")["rows_replaced"] == 1


def test_of_two_writers_the_later_fails(spark, tmp_path):
    t = str(tmp_path / "t")
    store.upsert(rows(spark, ("a", 1)), t, ["k"])
    number, version = store.current(spark, t)
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit(spark, t, number, version)


def test_stream_promotes_each_file_once(spark, tmp_path):
    raw, t, c = (str(tmp_path / x) for x in ("raw", "t", "c"))
    rows(spark, ("a", 1), ("b", 1)).write.parquet(f"{raw}/one")
    promote(spark, raw, SCHEMA, t, c, ["k"])
    rows(spark, ("b", 2)).write.parquet(f"{raw}/two")
    for _ in range(2):
        promote(spark, raw, SCHEMA, t, c, ["k"])
    assert sorted(map(tuple, store.read_table(spark, t).collect())) == [("a", 1), ("b", 2)]
