"""Catalog tables that a batch replaces at once, and the landing zone's batches."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.functions.names import payload


def replace(df: DataFrame, name: str) -> None:
    """Makes df the table's content: written aside first, then renamed into place.

    The table as it was stays as <name>_old until the next replacement, so readers of it can finish,
    and a batch may read the table it replaces.
    """
    spark = df.sparkSession
    aside, old = f"{name}_staging", f"{name}_old"
    spark.sql(f"DROP TABLE IF EXISTS {aside}")
    df.write.format("parquet").saveAsTable(aside)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} RENAME TO {old.split('.')[-1]}")
    spark.sql(f"ALTER TABLE {aside} RENAME TO {name.split('.')[-1]}")


#: Column of tables laid out in buckets of their keys.
BUCKET = "_bucket"
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def bucket_of(keys: Sequence[str], schema: T.StructType, buckets: int) -> Column:
    """The bucket of a row by its keys, as values of the table's types: neither the session's time zone nor a batch's narrower type moves a key."""
    kinds = {f.name.lower(): f.dataType for f in schema}
    return F.pmod(F.xxhash64(*[F.col(k).try_cast(kinds[k.lower()]) for k in keys]), F.lit(buckets)).cast("int")


def merge_touched(batch: DataFrame, name: str, keys: Sequence[str], merge: Callable[[DataFrame | None, DataFrame], DataFrame], buckets: int) -> None:
    """Merges a batch into a table that is partitioned by buckets of its keys; only buckets that the batch touches are read and written.

    merge(target or None, batch) gives the merged rows and keeps every key of the target. The buckets written are replaced
    when the write commits. Columns that are new are added to the table. A table that exists without
    buckets is laid out anew once.
    """
    spark = batch.sparkSession
    target = current(spark, name)
    of = bucket_of(keys, batch.schema if target is None else target.schema, buckets)
    if target is None or BUCKET not in target.columns:
        if target is not None:
            old = f"{name}_old"
            spark.sql(f"DROP TABLE IF EXISTS {old}")
            spark.sql(f"ALTER TABLE {name} RENAME TO {old.split('.')[-1]}")
            target = spark.table(old)
        merge(target, batch).withColumn(BUCKET, of).repartition(BUCKET).write.format("parquet").partitionBy(BUCKET).saveAsTable(name)
        return
    touched = [r["b"] for r in batch.select(of.alias("b")).distinct().collect()]  # at most as many as there are buckets
    merged = merge(target.where(F.col(BUCKET).isin(touched)).drop(BUCKET), batch)
    known = {c.lower() for c in target.columns}
    if new := [f"`{f.name}` {f.dataType.simpleString()}" for f in merged.schema if f.name.lower() not in known]:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(new)})")
    rows = merged.withColumn(BUCKET, of).select(spark.table(name).columns).repartition(BUCKET)
    mode = spark.conf.get(OVERWRITE)
    spark.conf.set(OVERWRITE, "dynamic")  # by the session, as only then may a query overwrite partitions of the table it reads
    try:
        rows.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE, mode)


def scratch(spark: SparkSession, kind: str) -> str:
    """A new folder that all executors share: in the checkpoint folder, or else in the warehouse."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def local(path: str) -> str:
    """A folder's path for programs that open files themselves, such as a database in a file; it must be mounted wherever they run."""
    scheme, _, rest = path.partition(":")
    if rest.startswith("/") and scheme != "file":
        raise ValueError(f"{path} is no mounted folder")
    out = re.sub("^/*", "/", rest) if scheme == "file" else path
    Path(out).parent.mkdir(parents=True, exist_ok=True)
    return out


def restore(spark: SparkSession, name: str) -> None:
    """Puts <name>_old back where a replacement broke off between its two renames."""
    if not spark.catalog.tableExists(name) and spark.catalog.tableExists(f"{name}_old"):
        spark.sql(f"ALTER TABLE {name}_old RENAME TO {name.split('.')[-1]}")


def current(spark: SparkSession, name: str) -> DataFrame | None:
    restore(spark, name)
    return spark.table(name) if spark.catalog.tableExists(name) else None


def publish(df: DataFrame, name: str, keys: Sequence[str]) -> None:
    """Replaces a serving table after checking its name and that keys are unique and not null."""
    if not name.split(".")[-1].startswith("gold_"):
        raise ValueError(f"{name} is no serving table")
    bad = df.groupBy(*keys).count().where("count > 1" + "".join(f" OR {k} IS NULL" for k in keys))
    if not bad.isEmpty():
        raise ValueError(f"{name}: keys {list(keys)} are null or not unique")
    replace(df, name)


def land(df: DataFrame, path: str, source: str, table: str, run_id: str, ingested_at: str, kind: str = "parquet", rows_per_file: int = 0) -> None:
    """Appends a batch to the landing zone as its own partition; the committer publishes all of its files or none."""
    stamped = df.withColumns({"_source_system": F.lit(source), "_table_name": F.lit(table), "_execution_id": F.lit(run_id), "_ingested_at": F.lit(ingested_at)})
    ordered = stamped.select(*[c for c in df.columns if not c.startswith("_")], *[c for c in stamped.columns if c.startswith("_")])
    typed = ordered.select(*[F.col(c).cast("string") if k == "void" else F.col(c) for c, k in ordered.dtypes])
    typed.write.partitionBy("_ingested_at").mode("append").option("maxRecordsPerFile", rows_per_file).format(kind).save(path)


def drop_columns(spark: SparkSession, name: str, columns: Sequence[str]) -> None:
    """Rewrites a table without some of its columns."""
    df = spark.table(name)
    if keep := [c for c in df.columns if c not in columns]:
        replace(df.select(keep), name)


def content_equal(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> bool:
    """Whether two tables hold the same business content, technical columns aside."""
    cols = [*keys, *payload(left.columns, list(keys))]
    return left.select(cols).exceptAll(right.select(cols)).isEmpty() and right.select(cols).exceptAll(left.select(cols)).isEmpty()
