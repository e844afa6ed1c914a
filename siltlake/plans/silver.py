"""Loading landed batches into conformed tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.operators import dedup, merge, transform
from siltlake.sinks import state, tables


@dataclass
class Load:
    """How a table is loaded. order lists the columns that date a row, the main one first."""

    source: str
    table: str
    keys: Sequence[str]
    order: Sequence[str]
    strategy: str = "scd1"
    earliest: bool = False
    watermark: str = "_ingested_at"
    #: Buckets of keys the table is laid out in, so that a batch rewrites those it touches alone; 0 rewrites the table.
    buckets: int = 0
    transform: transform.Transform = field(default_factory=transform.Transform)

    def __post_init__(self):
        self.transform.keys, self.transform.order = self.keys, self.order[0]


def increment(landed: DataFrame, column: str, after: str) -> DataFrame:
    """Rows past the high-water mark; on a partition column only new partitions are read.

    Text is compared as text; a timestamp as such, so that the filter reaches the scan.
    """
    if isinstance(landed.schema[column].dataType, T.TimestampType):
        return landed.where(F.col(column) > F.lit(after).cast("timestamp"))
    return landed.where(F.col(column).cast("string") > F.lit(after))


def conform(batch: DataFrame, load: Load, run_at: Column) -> DataFrame:
    """One transformed row per key of a batch."""
    one = dedup.latest(batch, load.keys, [c for c in load.order if c in batch.columns], load.earliest)
    return transform.run(one, load.transform, run_at, {"source": load.source, "table": load.table})


def run(spark: SparkSession, landing: str, states: str, load: Load, run_at: str, full: bool = False) -> int | None:
    """Loads what is new, then moves the watermark. A run that is repeated changes nothing.

    Returns the batch's rows, or None where nothing has landed.
    """
    if not state.exists(spark, landing):
        return None
    after = state.read_watermark(spark, states, load.source, load.table, full)
    batch = increment(spark.read.option("mergeSchema", True).parquet(landing), load.watermark, after)
    top, n = state.next_watermark(batch, load.watermark)
    if top is None:
        return 0
    at = F.lit(run_at).cast("timestamp")
    name = f"tbl_{load.table}"
    renamed = load.transform.renames
    keys, order = [renamed.get(k, k) for k in load.keys], renamed.get(load.order[0], load.order[0])
    one, merged = conform(batch, load, at), lambda target, rows: merge.apply(load.strategy, target, rows, keys, order, at)
    if load.buckets and load.strategy in merge.STRATEGIES:
        tables.merge_touched(one, name, keys, merged, load.buckets)
    else:
        tables.replace(merged(tables.current(spark, name), one), name)
    state.write_watermark(spark, states, load.source, load.table, top, "SUCCESS", n, run_at)
    return n


def run_all(spark: SparkSession, root: str, states: str, loads: Sequence[Load], run_at: str) -> dict[str, str]:
    """Loads every table; one that fails does not stop the others, and all failures are raised at the end."""
    status = {}
    for load in loads:
        try:
            n = run(spark, f"{root}/{load.table}", states, load, run_at)
            status[load.table] = "skipped: nothing landed" if n is None else f"ok: {n} rows"
        except Exception as e:
            status[load.table] = f"failed: {e}"
    if failed := {t: s for t, s in status.items() if s.startswith("failed")}:
        raise RuntimeError(f"tables failed: {failed}")
    return status
