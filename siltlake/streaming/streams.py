"""Structured Streaming forms of the incremental loads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from siltlake.operators import dedup, merge
from siltlake.sinks import tables


def landed(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet", files: int = 1000, archive: str | None = None) -> DataFrame:
    """New files of a folder as a stream, at most so many a batch; read files can move to an archive."""
    reader = spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", files)
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return reader.load(path)


def merge_stream(stream: DataFrame, table: str, keys: Sequence[str], order: str, strategy: str, run_at: Column, checkpoint: str, buckets: int = 0) -> StreamingQuery:
    """Merges everything that is new into a table and stops; the checkpoint holds what was read.

    A batch that is merged again after a failure leaves the table as one merge does. With buckets, a batch
    rewrites only the buckets of keys that it touches.
    """

    def one(batch: DataFrame, _: int) -> None:
        rows = dedup.latest(batch, keys, [order])
        merged = lambda target, new: merge.apply(strategy, target, new, keys, order, run_at)
        if buckets:
            tables.merge_touched(rows, table, keys, merged, buckets)
        else:
            tables.replace(merged(tables.current(batch.sparkSession, table), rows), table)

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, stamp: str, by: Sequence[str], size: str, late: str, slide: str | None = None) -> DataFrame:
    """Counts and sums of `value` per event-time window; rows later than `late` behind the newest are left out."""
    return stream.withWatermark(stamp, late).groupBy(F.window(stamp, size, slide or size).alias("w"), *by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total")


def first_seen(stream: DataFrame, keys: Sequence[str], stamp: str, late: str) -> DataFrame:
    """The first row of each key; keys are remembered as long as rows may be late."""
    return stream.withWatermark(stamp, late).dropDuplicatesWithinWatermark(list(keys))
