"""Window operators: nearest preceding rows, numbers, ordered lists, top rows per key.

A window or list of a key is the work of one task. With `hot`, keys of more than a HOT_SHARE-th of all rows, and of more than
`least`, are cut into blocks of their order instead, written once: ranges of about `least` rows, or of more where these would be
over BLOCKS in number, up to HOT_ROWS rows. What a block adds is worked out
for every block on its own, a row for each block carries what came before it, and a second step takes both together. Finding
those keys is a count over df, which is read twice then; all others take the plain way.
Rows of a key that are equal in the order columns stay in one block, and come in no defined order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.functions import exprs
from siltlake.sinks import tables

#: There are fewer hot keys than this, since each has more than such a part of all rows; and none has fewer than HOT_ROWS.
HOT_SHARE, HOT_ROWS = 1000, 200_000
#: Blocks beyond which they get larger instead of more: bounds are drawn from a hundred rows a block on the driver, and each block is a task.
BLOCKS = 200


def blocks_of(n: int, least: int) -> int:
    """Into how many blocks n rows of hot keys are cut."""
    return max(2, min(-(-n // least), max(BLOCKS, -(-n // max(least, HOT_ROWS)))))


def apart(df: DataFrame, keys: Sequence[str], order: Sequence[str], least: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of all keys that are not hot, and those of hot ones with __hot, the key's number, and __block, which follows the order within it."""
    spark = df.sparkSession
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    whole = counts.agg(F.sum("__n")).scalar()
    hot = counts.where(F.col("__n") > F.greatest(F.lit(float(least)), whole / float(HOT_SHARE))).collect()  # fewer than HOT_SHARE
    if not hot:
        return df, None
    numbered = spark.createDataFrame([(*r, k) for k, r in enumerate(hot)], counts.schema.add("__hot", T.IntegerType()))
    side = numbered.select(*[F.col(k).alias(f"__k{n}") for n, k in enumerate(keys)], "__hot")
    same = reduce(Column.__and__, [df[k].eqNullSafe(side[f"__k{n}"]) for n, k in enumerate(keys)])
    rows = df.join(F.broadcast(side), same).select(*df.columns, "__hot")
    blocks = blocks_of(sum(r["__n"] for r in hot), least)
    dealt = rows.repartitionByRange(blocks, "__hot", *order).withColumn("__block", F.spark_partition_id())
    # Written, since ranges that are drawn again may have other bounds.
    where = tables.scratch(spark, "blocks")
    dealt.write.parquet(where)
    return df.join(F.broadcast(side), same, "left_anti"), spark.read.parquet(where)


def before(summary: DataFrame, value: Column) -> DataFrame:
    """__hot, __block and __carry: an aggregate of a column over the blocks before each block of its key. A row for each block is sorted."""
    w = Window.partitionBy("__hot").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    return summary.select("__hot", "__block", value.over(w).alias("__carry"))


def nearest_preceding(df: DataFrame, keys: Sequence[str], order: Sequence[str], when: Column, take: dict[str, Column], hot: bool = False, least: int = HOT_ROWS) -> DataFrame:
    """df with the given columns of the nearest earlier row of the same keys for which `when` holds.

    One pass over a sorted window instead of a join of every row with all before it.
    """
    taken = F.struct(*[v.alias(n) for n, v in take.items()])
    found = F.last(F.when(when, taken), ignorenulls=True)
    shown = [*df.columns, *[F.col(f"__near.{n}").alias(n) for n in take]]
    cold, blocks = apart(df, keys, order, least) if hot else (df, None)
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    plain = cold.withColumn("__near", found.over(w)).select(*shown)
    if blocks is None:
        return plain
    # max_by passes over rows whose rank is null.
    last = blocks.groupBy("__hot", "__block").agg(F.max_by(taken, F.when(when, F.struct(*order))).alias("__last"))
    carried = blocks.join(before(last, F.last("__last", ignorenulls=True)), ["__hot", "__block"])
    inside = Window.partitionBy("__hot", "__block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return plain.unionByName(carried.withColumn("__near", F.coalesce(found.over(inside), "__carry")).select(*shown))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, hot: bool = False, least: int = HOT_ROWS) -> DataFrame:
    """df with the number of each row within its key, from 1 on."""
    cold, blocks = apart(df, keys, order, least) if hot else (df, None)
    plain = cold.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    if blocks is None:
        return plain
    sizes = blocks.groupBy("__hot", "__block").agg(F.count(F.lit(1)).alias("__n"))
    carried = blocks.join(before(sizes, F.sum("__n")), ["__hot", "__block"])
    inside = F.row_number().over(Window.partitionBy("__hot", "__block").orderBy(*order))
    return plain.unionByName(carried.withColumn(name, F.coalesce("__carry", F.lit(0)) + inside).select(*df.columns, name))


def ordered_list(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, separator: str = "; ", hot: bool = False, least: int = HOT_ROWS) -> DataFrame:
    """A row for each key with its values as text, in order and joined; nulls are skipped.

    The values of a hot key are sorted and joined block by block; only the blocks' texts meet, since they are one cell in the end.
    """
    cold, blocks = apart(df, keys, order, least) if hot else (df, None)
    of = exprs.ordered_list(F.struct(*order), value, separator)
    plain = cold.groupBy(*keys).agg(of.alias(name))
    if blocks is None:
        return plain
    parts = blocks.groupBy(*keys, "__hot", "__block").agg(F.when(F.count(value) > 0, of).alias("__part"))
    return plain.unionByName(parts.groupBy(*keys).agg(exprs.ordered_list(F.col("__block"), F.col("__part"), separator).alias(name)))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def lookup(df: DataFrame, dim: DataFrame | None, ref: str, key: str, take: dict[str, str]) -> DataFrame:
    """df with columns of a dimension by reference; without the dimension they are null.

    The dimension is cut to what is taken; whether it is small enough to broadcast is left to the
    planner, which knows its size.
    """
    if dim is None:
        return df.withColumns({n: F.lit(None).cast("string") for n in take.values()})
    side = dim.select(F.col(key).alias("__key"), *[F.col(c).alias(n) for c, n in take.items()]).dropDuplicates(["__key"])
    return df.join(side, df[ref] == side["__key"], "left").drop("__key")
