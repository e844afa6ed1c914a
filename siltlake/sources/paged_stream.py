"""Paged record services as a stream: how far each share was read stands in the stream's checkpoint."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from siltlake.sources.paged import time_windows


@dataclass
class Span(InputPartition):
    """A share's records of low <= stamp < high."""

    share: str
    low: str
    high: str


class PagedStreamReader(DataSourceStreamReader):
    """Offsets are times by share. A batch is planned before it is read and planned times do not move: one that breaks off is read again as it was."""

    def __init__(self, pages: Any, shares: Mapping[str, Mapping[str, Any]], newest: Callable[[str], str], start: str, days: int, stamp: str | None):
        self.pages, self.shares, self.newest, self.start, self.days, self.stamp = pages, shares, newest, start, days, stamp

    def initialOffset(self) -> dict[str, str]:
        return dict.fromkeys(self.shares, self.start)

    def latestOffset(self) -> dict[str, str]:
        return {s: max(self.start, self.newest(s)) for s in self.shares}

    def partitions(self, start: dict[str, str], end: dict[str, str]) -> list[Span]:
        """Half-open windows of so many days; a share that the offsets do not know yet begins at the start."""
        out = []
        for share in self.shares:
            low, high = (datetime.fromisoformat(x.get(share, self.start)) for x in (start, end))
            out += [Span(share, a.isoformat(), b.isoformat()) for a, b in time_windows(low, high, self.days)]
        return out

    def read(self, partition: Span) -> Iterator[tuple[str, str]]:
        query = {**self.shares[partition.share], "low": partition.low, "high": partition.high}
        low, high = datetime.fromisoformat(partition.low), datetime.fromisoformat(partition.high)
        for r in self.pages.rows(query):
            at = r.get(self.stamp) if self.stamp else None
            if at is None or low <= datetime.fromisoformat(at) < high:
                yield partition.share, json.dumps(r)


class PagedStream(DataSource):
    make: Callable[[], PagedStreamReader]

    @classmethod
    def name(cls) -> str:
        return "siltlake_paged_stream"

    def schema(self) -> str:
        return "share string, record string"

    def streamReader(self, schema: T.StructType) -> PagedStreamReader:
        return type(self).make()


def stream(spark: SparkSession, pages: Any, schema: T.StructType | str, shares: Mapping[str, Mapping[str, Any]], newest: Callable[[str], str], start: str, days: int = 15, stamp: str | None = None) -> DataFrame:
    """A service's records as they come, with the share's name in _share.

    shares are queries by name, to which each task adds the times low and high of its window. newest tells up to which time, itself
    excluded, a share's records are all there. A service that takes bounds loosely is held to them by the field `stamp`; records without it
    are kept, so the service must send them once. A share that is added later begins at `start`.
    """
    made = staticmethod(lambda: PagedStreamReader(pages, shares, newest, start, days, stamp))
    spark.dataSource.register(type("Stream", (PagedStream,), {"make": made, "name": classmethod(lambda cls: "siltlake_paged_stream")}))
    rows = spark.readStream.format("siltlake_paged_stream").load()
    return rows.select(F.from_json("record", schema).alias("r"), "share").select("r.*", F.col("share").alias("_share"))
