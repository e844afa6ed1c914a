"""File sources: CSV, JSON, text and Parquet, with fetch modes by modification time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltlake.operators import records

#: Keys under which a JSON document may hold its records.
RECORD_KEYS = ("data", "records", "value", "entities")


def csv(spark: SparkSession, path: str, header: bool = True, sep: str = ",", encoding: str = "UTF-8", escape: str = "\\", multiline: bool | str = True, **options) -> DataFrame:
    """CSV or TSV as strings; without a header columns are col_0, col_1, ...

    Fields may span lines, for which a task reads a file whole; with multiline off, large files are split among tasks. With `split`
    for multiline both hold (see csv_in_splits).
    """
    if multiline == "split":
        return csv_in_splits(spark, path, header, sep, escape, encoding=encoding, **options)
    df = spark.read.options(header=header, sep=sep, multiLine=multiline, escape=escape, encoding=encoding, inferSchema=False, **options).csv(path)
    return df if header else df.toDF(*[f"col_{i}" for i in range(len(df.columns))])


#: Files, or parts of files, of which a row each is broadcast at most; more are joined by shuffle.
FEW = 100_000


def listed(spark: SparkSession, path: str | list[str], **options) -> tuple[int, int]:
    """How many files there are and their bytes, from the listing alone."""
    kept = {k: v for k, v in options.items() if k in ("pathGlobFilter", "modifiedBefore", "modifiedAfter", "recursiveFileLookup")}
    n, size = spark.read.format("binaryFile").options(**kept).load(path).agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    return n, size


def beside(spark: SparkSession, side: DataFrame, path: str | list[str], parts: bool, **options) -> DataFrame:
    """side, a row for each file or each part of one that a task reads, to be broadcast if those are few."""
    n, size = listed(spark, path, **options)
    of_parts = size // spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() if parts else 0
    return F.broadcast(side) if n + of_parts <= FEW else side


def numbered_lines(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """file, split, id and line: the place where a task's part of a file begins, and numbers that rise with the lines in it."""
    return spark.read.options(**options).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line")
    )


def json_texts(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """source_file and record: the JSON text of every record of line-delimited files and of whole documents, told file by file.

    A file's lines count up to the first that is no JSON; values that are no objects are passed over, as are blank lines. A file without
    any object on such a line is one document: an array, an object that holds one under a known key, or a single object. A
    document that is no JSON ends the job. Large files are split among tasks: the first bad line is the least place
    over a file's parts. Documents alone are put together, each in one cell, as parsing them needs.
    """
    lines = numbered_lines(spark, path, **options).withColumn("line", F.trim("line")).where("line <> ''")
    parsed = lines.withColumn("v", F.try_parse_json("line"))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("v"), F.lit("OBJECT")), F.lit(False))
    told = parsed.select("file", "split", "id", F.col("v").isNull().alias("bad"), is_object.alias("object"))
    at = F.struct("split", "id")
    ends = told.groupBy("file").agg(F.min(F.when(F.col("bad"), at)).alias("end"), F.min(F.when(F.col("object"), at)).alias("begin"))
    forms = ends.select("file", "end", (F.col("begin").isNotNull() & (F.col("end").isNull() | (F.col("begin") < F.col("end")))).alias("by_line"))
    met = parsed.join(beside(spark, forms, path, False, **options), "file")
    by_line = met.where(F.col("by_line") & is_object & (F.col("end").isNull() | (at < F.col("end")))).select("file", F.col("line").alias("record"))
    # Lines without the white space at their ends, and without blank ones, parse as the document does, but for strings over lines, which JSON has not.
    whole = met.where(~F.col("by_line")).groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "id", "line"))), lambda x: x.line), "\n").alias("text"))
    document = F.try_parse_json("text")
    lists = [F.variant_get("v", f"$.{k}", "variant") for k in RECORD_KEYS]
    is_list = lambda v: F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("ARRAY")), F.lit(False))
    held_in = F.coalesce(*[F.when(is_list(v), v) for v in (F.col("v"), *lists)])
    single = F.when(is_object, F.array("v"))
    wrong = F.raise_error(F.concat(F.lit("no JSON in "), "file")).cast("array<variant>")
    opened = whole.withColumn("v", document).select("file", F.explode(F.when(F.col("v").isNull(), wrong).otherwise(F.coalesce(held_in.try_cast("array<variant>"), single))).alias("v"))
    records = by_line.unionByName(opened.where(is_object).select("file", F.to_json("v").alias("record")))
    return records.select(F.col("file").alias("source_file"), "record")


def plain_type(kind: T.DataType) -> T.DataType:
    """A schema merged over records as the JSON reader would have it: numbers with a point are doubles, and what differs by record is a string."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain_type(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain_type(kind.elementType))
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    return T.DoubleType() if isinstance(kind, (T.DecimalType, T.FloatType)) else kind


def json_records(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, **options) -> DataFrame:
    """Records of line-delimited JSON and of whole documents (see json_texts), as columns; without a schema that of all records is found in a pass of its own."""
    found = json_texts(spark, path, **options)
    if schema is None:
        text = found.agg(F.schema_of_variant_agg(F.parse_json("record"))).first()[0]
        if not (text or "").startswith("OBJECT<"):
            return spark.createDataFrame([], T.StructType())
        schema = plain_type(records.parsed_schema(text))
    return found.select(F.from_json("record", schema).alias("r")).select("r.*")


def parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.read.options(mergeSchema=True, **options).parquet(path)


def text_lines(spark: SparkSession, path: str, **options) -> DataFrame:
    """line_number from 1 within each file, line_content and source_file.

    Files are split among tasks: a line's place within its split is added to the lines of the file's splits before,
    which one row a split tells.
    """
    lines = numbered_lines(spark, path, **options)
    splits = lines.groupBy("file", "split").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    starts = splits.select("file", "split", (F.coalesce(F.sum("n").over(earlier_splits()), F.lit(0)) - F.col("first") + 1).alias("shift"))
    met = lines.join(beside(spark, starts, path, True, **options), ["file", "split"])
    return met.select((F.col("id") + F.col("shift")).alias("line_number"), F.col("line").alias("line_content"), F.col("file").alias("source_file"))


def earlier_splits() -> WindowSpec:
    return Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)


def unescaped(line: str, quote: str, escape: str) -> int:
    """The quotes of a line that open or close a field; a doubled quote opens and closes, and so changes nothing."""
    if escape == quote or escape not in line:
        return line.count(quote)
    return re.sub(re.escape(escape) + "(?:.|$)", "", line, flags=re.S).count(quote)


def split_quotes(quote: str, escape: str):
    """A row for each split that a task reads: whether the number of its quotes is odd."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd: dict[tuple[str, int], int] = {}
        for batch in batches:
            for file, split, line in zip(batch["file"].to_pylist(), batch["split"].to_pylist(), batch["line"].to_pylist()):
                odd[file, split] = odd.get((file, split), 0) ^ unescaped(line, quote, escape) & 1
        rows = [(f, s, n) for (f, s), n in odd.items()]
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "split", "odd"), r)) for r in rows], pa.schema([("file", pa.string()), ("split", pa.int64()), ("odd", pa.int64())]))

    return run


RECORDS = pa.schema([("file", pa.string()), ("split", pa.int64()), ("record", pa.string()), ("open", pa.bool_()), ("goes_on", pa.bool_()), ("head", pa.bool_())])


def split_records(quote: str, escape: str):
    """The records of each split. One that a quote leaves open at the split's end goes on in the next, where its rest is the first, open row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, parts, begun, head, out = None, False, [], True, False, []

        def ended(goes_on: bool) -> None:
            out.append((*at, "\n".join(parts), not begun, goes_on, head))

        for batch in batches:
            for file, split, line, start in zip(batch["file"].to_pylist(), batch["split"].to_pylist(), batch["line"].to_pylist(), batch["start"].to_pylist()):
                if (file, split) != at:
                    if parts:
                        ended(True)
                    at, inside, parts, begun, head = (file, split), bool(start), [], not start, split == 0
                parts.append(line)
                inside ^= bool(unescaped(line, quote, escape) & 1)
                if not inside:
                    ended(False)
                    parts, begun, head = [], True, False
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RECORDS)] if out else [pa.array([], f.type) for f in RECORDS], schema=RECORDS)
            out = []
        if parts:
            ended(True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RECORDS)], schema=RECORDS)

    return run


def csv_in_splits(spark: SparkSession, path: str, header: bool = True, sep: str = ",", escape: str = "\\", quote: str = '"', **options) -> DataFrame:
    """CSV as strings, with fields over several lines and large files split among tasks.

    Whether a split begins inside quotes follows from the number of quotes before it: a row for each split says if its own is odd,
    and a sum over the file's splits tells each where it stands. Then every task cuts its lines where records
    end; a record that goes on past a split's end is put together from the pieces at the splits' edges, which alone are
    shuffled. A quote inside a field must be escaped or the field be quoted, and headers stand on one line. Line ends are those of
    `\n`, with a `\r` before it or not.
    """
    lines = numbered_lines(spark, path, lineSep="\n", **options)
    quotes = lines.select("file", "split", "line").mapInArrow(split_quotes(quote, escape), "file string, split long, odd long")
    starts = quotes.select("file", "split", (F.coalesce(F.sum("odd").over(earlier_splits()), F.lit(0)) % 2).alias("start"))
    side = beside(spark, starts, path, True, **options)
    met = lines.join(side, ["file", "split"]).select("file", "split", "id", "line", "start")
    if side is starts:  # a join by shuffle keeps no order
        met = met.repartition("file", "split").sortWithinPartitions("file", "split", "id")
    found = met.drop("id").mapInArrow(split_records(quote, escape), "file string, split long, record string, open boolean, goes_on boolean, head boolean")
    pieces = found.where("open OR goes_on")
    # A record that goes on has the number of those begun before; the pieces in between have the same.
    number = F.sum(F.when(F.col("open"), 0).otherwise(1)).over(Window.partitionBy("file").orderBy("split", F.col("open").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = pieces.withColumn("n", number).groupBy("file", "n").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "record"))), lambda x: x.record), "\n").alias("record"), F.bool_or("head").alias("head"))
    whole = found.where("NOT open AND NOT goes_on").select("record", "head").unionByName(joined.select("record", "head"))
    whole = whole.withColumn("record", F.regexp_replace("record", "\r$", "")).where("trim(record) <> ''")
    plain = {"sep": sep, "quote": quote, "escape": escape}
    names = spark.read.options(header=header, inferSchema=False, **plain, **options).csv(path).columns
    kind = T.StructType([T.StructField(f"c{n}", T.StringType()) for n in range(len(names))])
    rows = (whole.where("NOT head") if header else whole).select(F.from_csv("record", kind.simpleString()[len("struct<") : -1].replace(":", " "), plain).alias("r"))
    return rows.select(*[F.col(f"r.c{n}").alias(name if header else f"col_{n}") for n, name in enumerate(names)])


READERS = {"csv": csv, "json": json_records, "parquet": parquet, "text": text_lines}


def read(spark: SparkSession, kind: str, path: str, table: str | None = None, mode: str = "all", after: str | None = None, until: str | None = None, **options) -> DataFrame:
    """Files of a folder.

    mode `all` reads files modified after `after` (exclusive) and not after `until`; `latest` reads only the
    newest not after `until`. A path whose last part has wildcards is matched on file names; with a
    table, file names must begin with it and `_` or `.`.
    """
    folder, _, last = path.rpartition("/")
    if any(c in last for c in "*?["):
        path, options["pathGlobFilter"] = folder, last
    elif table:
        options["pathGlobFilter"] = f"{table}[_.]*"
    if until:
        options["modifiedBefore"] = until
    if mode == "latest":
        listing = spark.read.format("binaryFile").options(**{k: v for k, v in options.items() if k in ("pathGlobFilter", "modifiedBefore")}).load(path)
        newest = listing.select("path", "modificationTime").agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
        if newest is None:
            raise FileNotFoundError(f"no file under {path}")
        return READERS[kind](spark, newest, **{k: v for k, v in options.items() if k not in ("pathGlobFilter", "modifiedBefore")})
    if after:
        options["modifiedAfter"] = after
    return READERS[kind](spark, path, **options)
