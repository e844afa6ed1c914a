"""Relational sources and serving tables over JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def bounds(after: str | None, until: str | None) -> tuple[str | None, str | None]:
    """The bounds that hold; the sentinels of year 1900 and 9998 or 9999 mean none."""
    low = None if not after or after.startswith("1900") else after
    return low, None if not until or until.startswith(("9998", "9999")) else until


def incremental_query(table: str, stamp: str | None = None, after: str | None = None, until: str | None = None, where: str | None = None) -> str:
    """SELECT of the rows changed in (after, until]. The sentinels of year 1900 and 9999 mean no bound."""
    quoted = lambda v: "'" + v.replace("'", "''") + "'"
    low, high = bounds(after, until)
    parts = [f"({where})"] if where else []
    parts += [f"{stamp} {sign} {quoted(v)}" for sign, v in ((">", low), ("<=", high)) if stamp and v]
    return f"SELECT * FROM {table}" + (f" WHERE {' AND '.join(parts)}" if parts else "")


def read(spark: SparkSession, url: str, query: str, fetch: int = 10_000, split: tuple[str, str, str, int] | None = None, **options: str) -> DataFrame:
    """A query's rows; with split (column, lower, upper, parts) read by as many tasks."""
    reader = spark.read.format("jdbc").options(url=url, fetchsize=str(fetch), **options)
    if split is None:
        return reader.option("query", query).load()
    column, low, high, n = split
    return reader.options(dbtable=f"({query}) q", partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=str(n)).load()


def write_staging(df: DataFrame, url: str, table: str, **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=f"{table}_staging", **options).mode("overwrite").save()


def swap_statements(table: str, keys: Sequence[str] = (), exists: bool = True) -> list[str]:
    """Statements that put a staging table in a serving table's place at once (MySQL)."""
    if not table.startswith("gold_"):
        raise ValueError(f"{table} is no serving table")
    moves = ([f"{table} TO {table}_old"] if exists else []) + [f"{table}_staging TO {table}"]
    index = [f"CREATE INDEX ix_{table} ON {table} ({', '.join(keys)})"] if keys else []
    return [f"DROP TABLE IF EXISTS {table}_old", f"RENAME TABLE {', '.join(moves)}", f"DROP TABLE IF EXISTS {table}_old", *index]


def upsert_statement(table: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """Merges a staging table into a serving table by its unique key (MySQL); with keys alone, only new rows come in."""
    rest = [c for c in columns if c not in keys]
    names = ", ".join(columns)
    if not rest:
        return f"INSERT IGNORE INTO {table} ({names}) SELECT {names} FROM {table}_staging"
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM {table}_staging ON DUPLICATE KEY UPDATE " + ", ".join(f"{c} = VALUES({c})" for c in rest)
