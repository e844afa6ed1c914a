"""Windows and lists over keys that hold most of the rows."""

import pytest
from pyspark.sql import functions as F

from siltlake.operators import windows

def take():
    return {"near": F.col("id"), "what": F.col("v")}


def rows(spark, n=20_000):
    """One conversation of nearly all rows, one of a null key, and many small ones."""
    key = F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") % 10 < 9, F.concat(F.lit("c"), F.col("id") % 500))
    return spark.range(0, n, 1, 6).select(key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("o"), "id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), "id")).alias("v"))


def same(a, b):
    assert sorted(map(tuple, a.select(*sorted(a.columns)).collect()), key=repr) == sorted(map(tuple, b.select(*sorted(a.columns)).collect()), key=repr)


@pytest.mark.parametrize("when", ["id % 50 = 0", "id < 3", "false", "true"])
def test_nearest_preceding_by_blocks_is_that_by_windows(spark, when):
    df = rows(spark).cache()
    same(windows.nearest_preceding(df, ["k"], ["o", "id"], F.expr(when), take()), windows.nearest_preceding(df, ["k"], ["o", "id"], F.expr(when), take(), hot=True, least=1000))


def test_numbers_and_lists_by_blocks_are_those_by_windows(spark):
    df = rows(spark).cache()
    same(windows.numbered(df, ["k"], ["o", "id"], "n"), windows.numbered(df, ["k"], ["o", "id"], "n", hot=True, least=1000))
    for value in (F.col("v"), F.when(F.col("id") < 5, F.col("v")), F.lit(None).cast("string")):
        same(windows.ordered_list(df, ["k"], ["o", "id"], value, "l"), windows.ordered_list(df, ["k"], ["o", "id"], value, "l", hot=True, least=1000))


def test_blocks_bound_what_a_task_sorts(spark):
    cold, blocks = windows.apart(rows(spark), ["k"], ["o", "id"], 1000)
    sizes = [r["count"] for r in blocks.groupBy("__hot", "__block").count().collect()]
    assert sum(sizes) == 16_000 and max(sizes) <= 2500 and len(sizes) >= 12  # the hot key and the null key
    assert cold.count() == 4000 and {r["k"] for r in blocks.select("k").distinct().collect()} == {"hot", None}
    edges = blocks.where("k = 'hot'").groupBy("__block").agg(F.min("o").alias("low"), F.max("o").alias("high")).orderBy("__block").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(edges, edges[1:]))


def test_without_hot_keys_nothing_is_written(spark):
    cold, blocks = windows.apart(rows(spark), ["k"], ["o"])
    assert blocks is None and cold.count() == 20_000
    empty = rows(spark).limit(0)
    assert windows.nearest_preceding(empty, ["k"], ["o"], F.lit(True), take(), hot=True).count() == 0
    assert windows.ordered_list(empty, ["k"], ["o"], F.col("v"), "l", hot=True).count() == 0


def test_rows_of_equal_order_stay_in_a_block(spark):
    df = spark.range(5000).select(F.lit("a").alias("k"), (F.col("id") % 7).alias("o"), "id")
    _, blocks = windows.apart(df, ["k"], ["o"], 500)
    assert blocks.groupBy("o").agg(F.count_distinct("__block").alias("n")).where("n > 1").count() == 0
    assert sorted(r["n"] for r in windows.numbered(df, ["k"], ["o"], "n", hot=True, least=500).collect()) == list(range(1, 5001))


def test_many_blocks_become_larger_ones(spark, monkeypatch):
    assert [windows.blocks_of(n, 1000) for n in (1500, 16_000, 6_000_000, 40_000_000, 400_000_000)] == [2, 16, 200, 200, 2000]
    assert windows.blocks_of(6_000_000, 200_000) == 30
    monkeypatch.setattr(windows, "BLOCKS", 5)
    df = rows(spark)
    _, blocks = windows.apart(df, ["k"], ["o", "id"], 1000)
    assert blocks.select("__block").distinct().count() == 5
    same(windows.numbered(df, ["k"], ["o", "id"], "n"), windows.numbered(df, ["k"], ["o", "id"], "n", hot=True, least=1000))
