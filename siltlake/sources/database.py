"""Relational tables as a Spark data source with reads by key range and writes that commit at once.

Works over sqlite3, which comes with Python, and modules that speak as it does, named by the option `driver`. Reads are split by
ranges of one column, a query and a connection for each task; filters that the database can judge go into its WHERE clause.

Such a database has one writer at a time, so tasks do not write to it: each fills a small database of its own, in a folder
beside the table's, and tries that break off leave nothing that counts. With keys, the rows come in the order of the keys,
sorted by Spark, so that the index is walked once and not at random. The commit lays the tasks' files together and brings
them into place within one transaction; an abort drops them. The folder goes with either, and without it no task
begins another file. Other sessions see the table as it was, or as it is afterwards.
"""

from __future__ import annotations

import datetime as dt
import importlib
import itertools
import os
import re
import shutil
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import closing, nullcontext
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import datasource as ds
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

#: Database types by Spark type, and Spark types by words in a declared database type.
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "SMALLINT", "double": "DOUBLE PRECISION", "float": "REAL", "boolean": "BOOLEAN", "binary": "BLOB", "date": "DATE", "timestamp": "TIMESTAMP"}
DECLARED = (("BOOL", "boolean"), ("BIGINT", "bigint"), ("SMALLINT", "smallint"), ("INT", "bigint"), ("DOUBLE", "double"), ("FLOA", "double"), ("REAL", "double"), ("BLOB", "binary"), ("TIMESTAMP", "timestamp"), ("DATETIME", "timestamp"), ("DATE", "date"))
#: Rows that are read with one call.
ROWS = 10_000
#: KiB of pages that a commit holds: each time they are full, the database waits for its disk.
CACHE = 65_536
#: Seconds to wait for another writer of a database that has one at a time.
WAIT = 600.0


def quoted(name: str) -> str:
    """An identifier; a schema's name before a point is kept apart."""
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


def connect(options: dict[str, str]):
    driver = options.get("driver", "sqlite3")
    if driver == "sqlite3":
        import sqlite3

        return sqlite3.connect(options["database"], timeout=WAIT, isolation_level=None)
    return importlib.import_module(driver).connect(options["database"])


def alone(db):
    """A cursor for a file that no other session reads and that is thrown away if its write breaks off: nothing is kept to undo."""
    cursor = db.cursor()
    cursor.execute("PRAGMA journal_mode = OFF")
    cursor.fetchall()
    cursor.execute("PRAGMA synchronous = OFF")
    return cursor


def flush(file: str) -> None:
    """Has a file's content written to its disk."""
    with open(file, "rb") as f:
        os.fsync(f.fileno())


def declared(kind: str | None) -> str:
    """The Spark type of a column declared with a database type; what is not known is a string."""
    text = (kind or "").upper()
    if m := re.match(r"(?:DECIMAL|NUMERIC)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", text):
        return f"decimal({m[1]},{m[2] or 0})"
    return next((spark for word, spark in DECLARED if word in text), "string")


def columns_of(cursor, table: str) -> list[tuple[str, str]]:
    """Names and declared types of a table's columns."""
    cursor.execute(f"PRAGMA table_info({quoted(table)})")
    return [(r[1], r[2]) for r in cursor.fetchall()]


def exists(cursor, table: str) -> bool:
    cursor.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND name = ?", (table,))
    return cursor.fetchone() is not None


def stored(values: pa.Array) -> list:
    """A column as the database keeps it: times, in UTC, and decimals as text, which sort as they should."""
    if pa.types.is_timestamp(values.type):
        return pc.replace_substring_regex(values.cast(pa.timestamp("us")).cast(pa.string()), r"\.000000$", "").to_pylist()
    if pa.types.is_date(values.type):
        return values.cast(pa.string()).to_pylist()
    if pa.types.is_decimal(values.type):
        return [v if v is None else str(v) for v in values.to_pylist()]
    return values.to_pylist()


def restored(kind: T.DataType):
    """What makes a database's value one of a Spark type."""
    if isinstance(kind, T.DecimalType):
        return lambda v: Decimal(str(v))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        zone = dt.UTC if isinstance(kind, T.TimestampType) else None
        return lambda v: (dt.datetime.fromtimestamp(v, dt.UTC) if isinstance(v, (int, float)) else dt.datetime.fromisoformat(v)).replace(tzinfo=zone)
    if isinstance(kind, T.DateType):
        return lambda v: dt.date.fromisoformat(v[:10])
    if isinstance(kind, T.StringType):
        return str
    if isinstance(kind, T.BooleanType):
        return bool
    return lambda v: v


@dataclass
class Range(InputPartition):
    """Rows with low <= column < high, each bound only if it is there; the first range has those with a null as well."""

    low: object
    high: object
    nulls: bool


class DatabaseReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType):
        self.options, self.schema = dict(options), schema
        self.where: list[tuple[str, list]] = []

    def source(self) -> str:
        return f"({self.options['query']}) AS q" if self.options.get("query") else quoted(self.options["table"])

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        """Takes comparisons of a number or text column with a value; Spark judges the others."""
        signs = {ds.EqualTo: "=", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=", ds.LessThan: "<", ds.LessThanOrEqual: "<="}
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if isinstance(f, ds.IsNotNull) and name:
                self.where.append((f"{quoted(name)} IS NOT NULL", []))
            elif type(f) in signs and name and isinstance(f.value, (int, float, str)) and not isinstance(f.value, bool) and f.value == f.value:
                self.where.append((f"{quoted(name)} {signs[type(f)]} ?", [f.value]))
            elif isinstance(f, ds.In) and name and all(isinstance(v, (int, str)) and not isinstance(v, bool) for v in f.value):
                self.where.append((f"{quoted(name)} IN ({', '.join('?' * len(f.value))})", list(f.value)))
            else:
                yield f

    def conditions(self, more: Sequence[tuple[str, list]] = ()) -> tuple[str, list]:
        parts = [*self.where, *more]
        return (" WHERE " + " AND ".join(f"({p})" for p, _ in parts) if parts else ""), [v for _, values in parts for v in values]

    def partitions(self) -> Sequence[InputPartition]:
        column, n = self.options.get("partitioncolumn"), int(self.options.get("numpartitions", "1"))
        if not column or n < 2:
            return [Range(None, None, True)]
        where, values = self.conditions()
        with closing(connect(self.options)) as db:
            cursor = db.cursor()
            cursor.execute(f"SELECT min({quoted(column)}), max({quoted(column)}) FROM {self.source()}{where}", values)
            low, high = cursor.fetchone()
            if low is None:
                return [Range(None, None, True)]
            if isinstance(low, int) and isinstance(high, int):
                cuts = [low + (high + 1 - low) * k // n for k in range(1, n)]
            else:  # text, as times are: places in the order of the column's own values
                cursor.execute(f"SELECT c FROM (SELECT {quoted(column)} AS c, ntile({n}) OVER (ORDER BY {quoted(column)}) AS part FROM {self.source()}{where}) AS t GROUP BY part HAVING c = min(c) ORDER BY part", values)
                cuts = [r[0] for r in cursor.fetchall()][1:]
        cuts = sorted({c for c in cuts if c is not None and c > low})
        return [Range(a, b, a is None) for a, b in itertools.pairwise([None, *cuts, None])]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        column, more = self.options.get("partitioncolumn"), []
        if partition.low is not None:
            more.append((f"{quoted(column)} >= ?", [partition.low]))
        if partition.high is not None:
            more.append((f"{quoted(column)} < ?" + (f" OR {quoted(column)} IS NULL" if partition.nulls else ""), [partition.high]))
        where, values = self.conditions(more)
        makers = [restored(f.dataType) for f in self.schema]
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(self.schema)
        with closing(connect(self.options)) as db:
            cursor = db.cursor()
            cursor.execute(f"SELECT {', '.join(quoted(f.name) for f in self.schema)} FROM {self.source()}{where}", values)
            while rows := cursor.fetchmany(ROWS):
                made = [[None if v is None else of(v) for v in column] for of, column in zip(makers, zip(*rows))]
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(made, arrow)], schema=arrow)


@dataclass
class Staged(WriterCommitMessage):
    file: str
    rows: int


class DatabaseWriter(DataSourceArrowWriter):
    """Appends, replaces the table, or with `keys` replaces the rows of the keys that come."""

    def __init__(self, options: dict[str, str], schema: T.StructType, overwrite: bool):
        self.options, self.schema, self.overwrite = dict(options), schema, overwrite
        self.table = self.options["table"]
        self.keys = [k.strip() for k in self.options.get("keys", "").split(",") if k.strip()]
        self.run = uuid.uuid4().hex[:12]
        if lacking := [k for k in self.keys if k not in schema.names]:
            raise ValueError(f"no column for keys {lacking}")
        self.folder = f"{self.options['database']}_staging_{self.run}"
        os.mkdir(self.folder)

    def definitions(self) -> str:
        return ", ".join(f"{quoted(f.name)} {KINDS.get(f.dataType.simpleString(), f.dataType.simpleString().upper() if isinstance(f.dataType, T.DecimalType) else 'TEXT')}" for f in self.schema)

    def names(self) -> str:
        return ", ".join(quoted(f.name) for f in self.schema)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        if not os.path.isdir(self.folder):
            raise RuntimeError(f"the write to {self.table} has ended")
        file = f"{self.folder}/{uuid.uuid4().hex}"
        insert = f"INSERT INTO staged ({self.names()}) VALUES ({', '.join('?' * len(self.schema))})"
        n = 0
        with closing(connect(self.options | {"database": file})) as db:
            cursor = alone(db)
            cursor.execute(f"CREATE TABLE staged ({self.definitions()})")
            cursor.execute("BEGIN")
            for batch in iterator:
                cursor.executemany(insert, zip(*map(stored, batch.columns)))
                n += batch.num_rows
            cursor.execute("COMMIT")
        flush(file)
        return Staged(file, n)

    def gathered(self, files: list[str]) -> str | None:
        """The first of the tasks' files, with the rows of all, in order; the others go. One file, since few can be open at a time."""
        with closing(connect(self.options | {"database": files[0]})) if files else nullcontext() as db:
            for file in files[1:]:
                cursor = alone(db)
                cursor.execute("ATTACH ? AS part", (file,))
                cursor.execute("INSERT INTO main.staged SELECT * FROM part.staged")
                cursor.execute("DETACH part")
                os.remove(file)
        return files[0] if files else None

    def commit(self, messages: list[Staged | None]) -> None:
        file = self.gathered([m.file for m in messages if m is not None and m.rows])
        with closing(connect(self.options)) as db:
            cursor = db.cursor()
            cursor.execute(f"PRAGMA cache_size = -{CACHE}")
            if file:
                cursor.execute("ATTACH ? AS part", (file,))
            cursor.execute("BEGIN IMMEDIATE")
            try:
                self.publish(cursor, bool(file))
                cursor.execute("COMMIT")
            except BaseException:
                cursor.execute("ROLLBACK")
                raise
        self.drop()

    def drop(self) -> None:
        """Takes the folder away: a task that runs on finds none, and what it has written goes too."""
        if os.path.isdir(self.folder):
            os.rename(self.folder, gone := f"{self.folder}_gone")
            shutil.rmtree(gone, ignore_errors=True)

    def publish(self, cursor, staged: bool) -> None:
        """Brings the staged rows into the table, within the caller's transaction."""
        there = exists(cursor, self.table)
        target = f"{self.table}_staging_{self.run}_new" if self.overwrite else self.table
        if self.overwrite or not there:
            cursor.execute(f"CREATE TABLE {quoted(target)} ({self.definitions()})")
        elif new := [f for f in self.schema if f.name.lower() not in {c.lower() for c, _ in columns_of(cursor, self.table)}]:
            for f in new:
                cursor.execute(f"ALTER TABLE {quoted(self.table)} ADD COLUMN {quoted(f.name)} {KINDS.get(f.dataType.simpleString(), 'TEXT')}")
        if staged and self.overwrite:  # as a whole, before there is an index
            cursor.execute(f"INSERT INTO {quoted(target)} SELECT * FROM part.staged")
        if self.keys and not self.indexed(cursor, target):
            cursor.execute(f"CREATE UNIQUE INDEX {quoted(f'ux_{self.table}_{self.run}')} ON {quoted(target)} ({', '.join(map(quoted, self.keys))})")
        if staged and not self.overwrite:
            cursor.execute(f"INSERT INTO {quoted(target)} ({self.names()}) SELECT {self.names()} FROM part.staged WHERE true{self.on_conflict()}")
        if self.overwrite:
            if there:
                cursor.execute(f"DROP TABLE {quoted(self.table)}")
            cursor.execute(f"ALTER TABLE {quoted(target)} RENAME TO {quoted(self.table)}")

    def indexed(self, cursor, table: str) -> bool:
        """Whether a unique index of the table has just the keys."""
        cursor.execute(f"PRAGMA index_list({quoted(table)})")
        for index in [r[1] for r in cursor.fetchall() if r[2] and not r[4]]:
            cursor.execute(f"PRAGMA index_info({quoted(index)})")
            if sorted(str(r[2]).lower() for r in cursor.fetchall()) == sorted(k.lower() for k in self.keys):
                return True
        return False

    def on_conflict(self) -> str:
        """What becomes of a row whose key the table has: its other columns are replaced, if one differs."""
        if not self.keys:
            return ""
        rest = [f.name for f in self.schema if f.name not in self.keys]
        sets = ", ".join(f"{quoted(c)} = excluded.{quoted(c)}" for c in rest)
        differs = " OR ".join(f"{quoted(self.table)}.{quoted(c)} IS NOT excluded.{quoted(c)}" for c in rest)
        return f" ON CONFLICT ({', '.join(map(quoted, self.keys))}) DO " + (f"UPDATE SET {sets} WHERE {differs}" if sets else "NOTHING")

    def abort(self, messages: list[Staged | None]) -> None:
        self.drop()


class DatabaseSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "database"

    def schema(self) -> str:
        with closing(connect(self.options)) as db:
            cursor = db.cursor()
            if self.options.get("query"):
                raise ValueError("a query needs a schema")
            found = columns_of(cursor, self.options["table"])
        if not found:
            raise ValueError(f"no table {self.options['table']}")
        return ", ".join(f"`{c.replace('`', '``')}` {declared(kind)}" for c, kind in found)

    def reader(self, schema: T.StructType) -> DatabaseReader:
        return DatabaseReader(self.options, schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> DatabaseWriter:
        return DatabaseWriter(self.options, schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(DatabaseSource)


def read(spark: SparkSession, database: str, table: str | None = None, query: str | None = None, schema: str | T.StructType | None = None, split: tuple[str, int] | None = None, driver: str = "sqlite3") -> DataFrame:
    """A table's rows, or a query's with the schema given; with split (column, parts) by as many tasks."""
    register(spark)
    of = {"database": database, "driver": driver} | ({"query": query} if query else {"table": table}) | ({"partitionColumn": split[0], "numPartitions": str(split[1])} if split else {})
    reader = spark.read.format("database").options(**of)
    return (reader.schema(schema) if schema else reader).load()


def write(df: DataFrame, database: str, table: str, mode: str = "append", keys: Sequence[str] = (), driver: str = "sqlite3") -> None:
    """Writes df. mode `append` adds rows, or with keys replaces those of the keys that come; `overwrite` replaces the table, with a unique index on the keys."""
    register(df.sparkSession)
    if keys:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    df.write.format("database").options(database=database, driver=driver, table=table, keys=",".join(keys)).mode(mode).save()
