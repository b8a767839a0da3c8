"""Foreign-key flags by every way of looking them up."""

import pytest
from pyspark.sql import functions as F

from relload.operators.fk import with_presence

WAYS = {"all values": (100, 100), "missing ids": (12, 0), "bitmaps": (0, 100), "shuffle": (0, 0)}
IDS = [None, -40000, -32768, -32767, -1, 0, 1, 2, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, 2**31 - 1, -(2**31)]
KNOWN = [-32768, -1, 1, 8, 32768, 65537, -(2**31), 5]


def _exchanges(df):
    tree = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in tree.splitlines() if "Exchange" in line and "Broadcast" not in line]


@pytest.mark.parametrize("way", WAYS)
def test_presence_is_the_same_by_every_way_of_lookup(spark, way):
    row_limit, bitmap_limit = WAYS[way]
    child = spark.createDataFrame([(i, n) for n, i in enumerate(IDS * 3)], "fk int, n int").repartition(3)
    keys = spark.createDataFrame([(k,) for k in KNOWN * 2], "id int")
    got = with_presence(child, "fk", keys, "has", row_limit, bitmap_limit)
    assert got.columns == ["fk", "n", "has"]
    rows = got.collect()
    assert sorted(r.n for r in rows) == list(range(3 * len(IDS)))
    assert all(r.has == (r.fk is None or r.fk in KNOWN) for r in rows)


def test_nothing_missing_and_empty_tables(spark):
    keys = spark.createDataFrame([(1,)], "id int")
    for ids, want in (([1, None], {True}), ([], set()), ([2, 3], {False})):
        child = spark.createDataFrame([(i,) for i in ids], "fk int")
        for limits in WAYS.values():
            assert {r.has for r in with_presence(child, "fk", keys, "has", *limits).collect()} == want
        assert {r.has for r in with_presence(child, "fk", keys.limit(0), "has", 0, 10).collect()} == {i is None for i in ids}


@pytest.mark.parametrize("way", ["all values", "missing ids", "bitmaps"])
def test_the_wide_child_stays_where_it_is(spark, way, tmpdir_path):
    """Above the bound of one lookup the next is taken; no shuffle carries the child's columns."""
    spark.range(20).select((F.col("id") % 17).cast("int").alias("fk"), F.repeat(F.lit("x"), 50).alias("payload")).write.parquet(tmpdir_path + "/child")
    child = spark.read.parquet(tmpdir_path + "/child")
    keys = spark.range(12).select(F.col("id").cast("int").alias("id"))
    row_limit, bitmap_limit = WAYS[way]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = with_presence(child, "fk", keys, "has", row_limit, bitmap_limit)
        assert not any("payload" in line or "Exchange hashpartitioning(fk" in line for line in _exchanges(got))
        assert "SortMergeJoin" not in got._jdf.queryExecution().executedPlan().toString().split("InMemoryTableScan")[0]
        assert got.where("has").count() == sum(1 for i in range(20) if i % 17 < 12)
        moved = with_presence(child, "fk", keys, "has", 0, 0)
        assert _exchanges(moved)  # the last way does move it
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
