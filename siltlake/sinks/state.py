"""Watermarks and run logs, one JSON document each, read and written through Spark so that any store works."""

from __future__ import annotations

import json
import time
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = "source_system string, table_name string, last_load_date string, last_status string, records long, updated_at string"
BEGINNING = "1900-01-01 00:00:00"
VERSION = "version-"


def write_watermark(spark: SparkSession, root: str, source: str, table: str, value: str, status: str, records: int, at: str) -> None:
    """Sets a table's watermark. The sentinels of 9998 and 9999 are no watermarks."""
    if value.startswith(("9998", "9999")):
        raise ValueError(f"{value} is a sentinel")
    row, where = [(source, table, value, status, records, at)], f"{root}/{source}/{table}"
    before = versions(spark, where)
    spark.createDataFrame(row, FIELDS).coalesce(1).write.json(f"{where}/{VERSION}{time.time_ns():020d}")
    for old in before:  # only once the new one is there: a run that breaks off leaves the one before
        file_system(spark, old).delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)


def file_system(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(spark._jvm.org.apache.hadoop.fs.Path(path))


def versions(spark: SparkSession, where: str) -> list[str]:
    """Written versions of a watermark, the newest last; one whose write broke off does not count."""
    if not exists(spark, where):
        return []
    found = [str(s.getPath()) for s in file_system(spark, where).listStatus(spark._jvm.org.apache.hadoop.fs.Path(where)) if s.getPath().getName().startswith(VERSION)]
    return sorted(p for p in found if exists(spark, f"{p}/_SUCCESS"))


def read_watermark(spark: SparkSession, root: str, source: str, table: str, full: bool = False) -> str:
    """The last load date; the beginning for a full load or a new table."""
    if full:
        return BEGINNING
    found = versions(spark, f"{root}/{source}/{table}")
    row = spark.read.schema(FIELDS).json(found[-1]).first() if found else None
    return row["last_load_date"] if row else BEGINNING


def all_watermarks(spark: SparkSession, root: str) -> DataFrame:
    """The newest watermark of every table."""
    rows = spark.read.schema(FIELDS).option("recursiveFileLookup", True).json(root).withColumn("version", F.regexp_extract("_metadata.file_path", f"/{VERSION}(\\d+)/", 1))
    newest = F.max_by(F.struct(*[F.col(c.split()[0]) for c in FIELDS.split(", ")]), "version").alias("w")
    return rows.groupBy(F.col("source_system").alias("s"), F.col("table_name").alias("t")).agg(newest).select("w.*")


def repair(text: str) -> list[dict[str, Any]]:
    """Documents in text that should be one JSON object a line: pretty-printed, glued together or an array."""
    out: list[Any] = []
    decoder, at = json.JSONDecoder(), 0
    while at < len(text):
        if text[at].isspace() or text[at] == ",":
            at += 1
            continue
        value, at = decoder.raw_decode(text, at)
        out += value if isinstance(value, list) else [value]
    return out


def log_run(spark: SparkSession, path: str, entries: list[dict[str, Any]]) -> None:
    """Appends a run's entries, one per table."""
    shape = "run_id string, table_name string, status string, records long, seconds double, error string, at string"
    names = [c.split()[0] for c in shape.split(", ")]
    spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], shape).coalesce(1).write.mode("append").json(path)


def next_watermark(batch: DataFrame, column: str = "_ingested_at") -> tuple[str | None, int]:
    """The largest value of a batch, after which its next read starts, and the batch's rows; read in one pass over that column."""
    return tuple(batch.agg(F.max(F.col(column).cast("string")), F.count(F.lit(1))).first())
