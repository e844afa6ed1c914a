"""Readers by type or by the source's name."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltlake.sources import database, files, jdbc, paged

Reader = Callable[[SparkSession, Mapping[str, Any]], DataFrame]


def _files(spark: SparkSession, c: Mapping[str, Any]) -> DataFrame:
    return files.read(spark, c.get("format", "csv"), c["path"], c.get("table"), c.get("fetch_mode", "all"), c.get("after"), c.get("until"), **c.get("options", {}))


def _database(spark: SparkSession, c: Mapping[str, Any]) -> DataFrame:
    return jdbc.read(spark, c["url"], jdbc.incremental_query(c["table"], c.get("stamp"), c.get("after"), c.get("until"), c.get("where")), **c.get("options", {}))


def _sqlite(spark: SparkSession, c: Mapping[str, Any]) -> DataFrame:
    """A table's increment: the bounds go to the database as filters."""
    low, high = jdbc.bounds(c.get("after"), c.get("until"))
    df = database.read(spark, c["database"], c.get("table"), c.get("query"), c.get("schema"), c.get("split"), c.get("driver", "sqlite3"))
    df = df.where(F.col(c["stamp"]) > low) if low and c.get("stamp") else df
    return df.where(F.col(c["stamp"]) <= high) if high and c.get("stamp") else df


def _offset(spark: SparkSession, c: Mapping[str, Any]) -> DataFrame:
    pages = paged.OffsetPages(c["fetch"], c.get("size", 1000), c.get("by", "offset"), c.get("records", "result"), c.get("numbered", False))
    return paged.read_paged(spark, pages, c["schema"], c.get("shares"))


def _cursor(spark: SparkSession, c: Mapping[str, Any]) -> DataFrame:
    pages = paged.CursorPages(c["fetch"], c.get("records", "value"), c.get("next", "@odata.nextLink"), tuple(c.get("unwrap", ())))
    return paged.read_paged(spark, pages, c["schema"], c.get("shares"))


READERS: dict[str, Reader] = {"file": _files, "database": _database, "sqlite": _sqlite, "offset": _offset, "cursor": _cursor}


def reader(source: str, config: Mapping[str, Any]) -> Reader:
    """The reader of config's type, else of the source's name."""
    for name in (config.get("type"), source):
        if name in READERS:
            return READERS[name]
    raise KeyError(f"no reader for {source}; types are {sorted(READERS)}")
