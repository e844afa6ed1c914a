"""The first load of a mart from files, and the ledger of the files that were loaded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.functions.names import sanitised
from siltlake.operators import dedup, merge, reconcile, tokens
from siltlake.sinks import state, tables

#: Where the files of a mart may lie in the folder of exports, and the folder for those that were loaded.
NAMES = ("{mart}.csv", "{mart}/", "{mart}.parquet", "{mart}")
ARCHIVE = "_archived"
#: Columns of the ledger; a file that is written anew has another size or time, and counts as new.
LEDGER = "path string, length long, modified timestamp, mart string, loaded_at timestamp"


def read(spark: SparkSession, path: str | list[str], kind: str | None = None) -> DataFrame:
    """CSV (double quotes, fields over several lines, all strings) or Parquet, by kind or else by suffix."""
    first = path if isinstance(path, str) else path[0]
    if (kind or first.rstrip("/").rpartition(".")[2]) == "parquet":
        paths = [path] if isinstance(path, str) else path
        return spark.read.option("mergeSchema", True).parquet(*paths)
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"', inferSchema=False).csv(path)


def load(spark: SparkSession, path: str | list[str], mart: str, keys: Sequence[str], run_at: Column, sensitive: object = None, tokenizer: tokens.Tokenizer | None = None, hook=None, buckets: int = 0) -> DataFrame:
    """Names, tokens, schema, hook, columns, one row per key, merge: the mart's table after loading files. With buckets only those that the files' keys touch are rewritten."""
    df = sanitised(read(spark, path))
    if tokenizer and (names := tokens.columns_of(sensitive)):
        df = tokens.tokenize(df, names, tokenizer)
    name = f"gold_{mart}"
    target = tables.current(spark, name)
    if target is not None:
        df = reconcile.reconcile(df, target.drop("_updated_at", "_inserted_at", tables.BUCKET).schema)
    if hook:
        df = df.transform(hook)
    df = reconcile.as_text(reconcile.resolve_columns(df, keys)).withColumns({"_updated_at": run_at, "_inserted_at": run_at})
    df = dedup.by_first_present(df, keys)
    merged = lambda target, rows: rows if target is None else merge.upsert(target, rows, keys)
    if buckets:
        tables.merge_touched(df, name, keys, merged, buckets)
    else:
        tables.replace(merged(target, df), name)
    return spark.table(name)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """path, length and modified of the files at a place, in it or below; none where nothing is there."""
    if not state.exists(spark, path):
        return spark.createDataFrame([], "path string, length long, modified timestamp")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return found.where(~F.col("path").rlike(r"/[._][^/]*$")).select("path", "length", F.col("modificationTime").alias("modified"))


def candidates(folder: str, mart: str, path: str | None = None, archived: bool = False) -> list[str]:
    """The places to look for a mart's files in, in this order: the one given, the default names, and the archive's."""
    bases = [folder.rstrip("/"), *([f"{folder.rstrip('/')}/{ARCHIVE}"] if archived else [])]
    return [*([path] if path else []), *(f"{b}/{n.format(mart=mart)}" for b in bases for n in NAMES)]


def loaded_before(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger) if state.exists(spark, ledger) else spark.createDataFrame([], LEDGER)


def new_files(spark: SparkSession, ledger: str, folder: str, mart: str, path: str | None = None, reload: bool = False) -> DataFrame:
    """path, length and modified of the files to load: those of the first place that has any, without those that the ledger has for the mart.

    With reload the ledger does not count. The archive is looked into too then, and where the mart's table is missing or empty.
    """
    target = tables.current(spark, f"gold_{mart}")
    bare = target is None or target.isEmpty()
    for place in candidates(folder, mart, path, archived=reload or bare):
        found = listing(spark, place)
        if not found.isEmpty():
            if reload:
                return found
            known = loaded_before(spark, ledger).where(F.col("mart") == mart).select("path", "length", "modified").distinct()
            return found.join(known, ["path", "length", "modified"], "left_anti")
    return listing(spark, f"{folder.rstrip('/')}/{ARCHIVE}/{mart}.none").limit(0)


def load_new(spark: SparkSession, ledger: str, folder: str, mart: str, keys: Sequence[str], run_at: Column, path: str | None = None, reload: bool = False, **options) -> int:
    """Loads a mart's files that were not loaded before, oldest first within a key by the merge's order, and then notes them in the ledger.

    The ledger is a folder of Parquet, to which a run adds its files once the table is written: a run that breaks off before is
    repeated, and merging a file again changes nothing. Returns how many files were loaded.
    """
    found = new_files(spark, ledger, folder, mart, path, reload).orderBy("modified", "path").collect()  # the new files of one mart's folder
    if not found:
        return 0
    load(spark, [r["path"] for r in found], mart, keys, run_at, **options)
    noted = spark.createDataFrame(found, "path string, length long, modified timestamp").select("*", F.lit(mart).alias("mart"), run_at.cast("timestamp").alias("loaded_at"))
    noted.coalesce(1).write.mode("append").parquet(ledger)
    return len(found)


def archive(spark: SparkSession, ledger: str, folder: str, mart: str) -> int:
    """Moves the files of a mart that the ledger has, and that lie in its places as they were loaded, to the archive; returns how many."""
    jvm, moved = spark._jvm, 0
    known = loaded_before(spark, ledger).where(F.col("mart") == mart).select("path", "length", "modified").distinct()
    root = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    base = fs.makeQualified(root).toString().rstrip("/")
    for place in dict.fromkeys(p.rstrip("/") for p in candidates(folder, mart)):
        for r in listing(spark, place).join(known, ["path", "length", "modified"], "left_semi").collect():
            source = jvm.org.apache.hadoop.fs.Path(r["path"])
            below = fs.makeQualified(source).toString().removeprefix(base).lstrip("/")
            target = jvm.org.apache.hadoop.fs.Path(f"{base}/{ARCHIVE}/{below}")
            fs.mkdirs(target.getParent())
            if fs.exists(target):
                fs.delete(target, False)
            moved += bool(fs.rename(source, target))
    return moved
