"""Paged record services as a Spark data source.

A client gives pages; the source deals them to tasks where page numbers or offsets are known beforehand,
and follows cursors in one task where they are not. Clients are plain objects that pickle, so tests
use in-memory ones and deployments real HTTP ones.
"""

from __future__ import annotations

import base64
import gzip
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from siltlake.sources import jdbc

Fetch = Callable[[dict[str, Any]], dict[str, Any]]


@dataclass
class OffsetPages:
    """Pages by offset, or by number, until one is short or the share's last page is read.

    A share names the offset (or number) of its first and of its last page; what else it has goes into the query.
    """

    fetch: Fetch
    size: int = 1000
    by: str = "offset"
    records: str = "result"
    numbered: bool = False

    def rows(self, share: dict[str, Any]) -> Iterator[dict]:
        at, last = share.get("first", 1 if self.numbered else 0), share.get("last")
        query = {k: v for k, v in share.items() if k not in ("first", "last")}
        while last is None or at <= last:
            page = self.fetch({**query, self.by: at, "limit": self.size}).get(self.records) or []
            yield from page
            if len(page) < self.size:
                return
            at += 1 if self.numbered else self.size

    def shares(self, pages: int, each: int) -> list[dict[str, Any]]:
        """Shares of so many pages each for a service that has so many pages; the last one has no end, for pages that came since."""
        step, start = (1, 1) if self.numbered else (self.size, 0)
        out = [{"first": start + k * step, "last": start + (k + each - 1) * step} for k in range(0, pages, each)] or [{}]
        out[-1].pop("last", None)
        return out


@dataclass
class CursorPages:
    """Pages that name the next one, under a dotted path."""

    fetch: Fetch
    records: str = "value"
    next: str = "@odata.nextLink"
    unwrap: tuple[str, ...] = ()

    def rows(self, share: dict[str, Any]) -> Iterator[dict]:
        query: dict[str, Any] | None = dict(share)
        while query is not None:
            page = self.fetch(query)
            for r in page.get(self.records) or []:
                for key in self.unwrap:
                    r = {k: v for k, v in r.items() if k != key} | (r.get(key) or {})
                yield r
            at: Any = page.get(self.next)
            if at is None and "." in self.next and self.next not in page:
                at = page
                for key in self.next.split("."):
                    at = (at or {}).get(key)
            query = {**share, "cursor": at} if at else None


def time_windows(low: datetime, high: datetime, days: int, now: datetime | None = None) -> list[tuple[datetime, datetime]]:
    """Half-open windows of so many days from low to high; a high date in the future ends now."""
    high = min(high, now) if now and (high.year >= 9000 or high > now) else high
    out = []
    while low < high:
        out.append((low, min(low + timedelta(days=days), high)))
        low = out[-1][1]
    return out


@dataclass
class HttpJson:
    """GET with retries: 429 by Retry-After, 5xx with growing waits, 401 once with a new token. Answers may be gzipped.

    The token goes into the header named auth under the scheme, as `Bearer`; basic() and api_key() make the headers
    of services without tokens.
    """

    url: str
    token: Callable[[bool], str] | None = None
    tries: int = 6
    busy_tries: int = 10
    headers: dict[str, str] = field(default_factory=dict)
    pause: Callable[[float], None] = time.sleep

    def __call__(self, query: dict[str, Any]) -> dict[str, Any]:
        from urllib.parse import urlencode

        url = query["cursor"] if str(query.get("cursor", "")).startswith("http") else f"{self.url}?{urlencode(query)}"
        fresh, failed, busy = False, 0, 0
        while failed < self.tries and busy < self.busy_tries:
            headers = {"Accept-Encoding": "gzip"} | self.headers | ({"Authorization": f"Bearer {self.token(fresh)}"} if self.token else {})
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=60) as r:
                    body = r.read()
                    return json.loads(gzip.decompress(body) if body[:2] == b"\x1f\x8b" else body)
            except urllib.error.HTTPError as e:
                if e.code == 401 and self.token and not fresh:
                    fresh = True
                elif e.code == 429:
                    busy += 1
                    self.pause(float(e.headers.get("Retry-After") or 60))
                elif e.code >= 500:
                    self.pause(min(60, 2**failed))
                    failed += 1
                else:
                    raise
        raise ConnectionError(f"{url}: no answer after {failed} failures and {busy} times busy")


def basic(user: str, password: str) -> dict[str, str]:
    """Headers of basic authentication."""
    return {"Authorization": "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode()}


def api_key(key: str, header: str = "X-API-Key") -> dict[str, str]:
    return {header: key}


@dataclass
class TokenCache:
    """A token until a minute before it expires. ask() gives the token and its seconds of life."""

    ask: Callable[[], tuple[str, float]]
    clock: Callable[[], float] = time.time
    value: str = ""
    until: float = 0.0

    def __call__(self, fresh: bool = False) -> str:
        if fresh or self.clock() >= self.until - 60:
            self.value, life = self.ask()
            self.until = self.clock() + life
        return self.value


class Share(InputPartition):
    def __init__(self, value: dict[str, Any]):
        self.value = value


class PagedSource(DataSource):
    """Rows of a client as JSON text in one column, a partition per share."""

    pages: Any = None
    shares: list[dict[str, Any]] = []

    @classmethod
    def name(cls) -> str:
        return "siltlake_paged"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PagedReader(self.pages, self.shares)


class PagedReader(DataSourceReader):
    def __init__(self, pages: Any, shares: list[dict[str, Any]]):
        self.pages, self.shares = pages, shares

    def partitions(self) -> list[InputPartition]:
        return [Share(s) for s in self.shares or [{}]]

    def read(self, partition: InputPartition) -> Iterator[tuple[str]]:
        for r in self.pages.rows(partition.value):
            yield (json.dumps(r),)


def read_paged(spark: SparkSession, pages: Any, schema: T.StructType | str, shares: list[dict[str, Any]] | None = None) -> DataFrame:
    """A service's records under the schema; every share (a time window, a page range) is read by a task of its own."""
    open_ended = [s for s in shares or [] if "first" in s and "last" not in s]
    if len(open_ended) > 1 or any(s["first"] < o["first"] and s.get("last", s["first"]) >= o["first"] for o in open_ended for s in shares or [] if "first" in s):
        raise ValueError("of shares by page only the last may be without an end, as others would read its rows too")
    source = type("Source", (PagedSource,), {"pages": pages, "shares": shares or [{}], "name": classmethod(lambda cls: "siltlake_paged")})
    spark.dataSource.register(source)
    return spark.read.format("siltlake_paged").load().select(F.from_json("record", schema).alias("r")).select("r.*")


def odata_filter(stamp: str, after: str | None = None, until: str | None = None, where: str | None = None) -> str:
    """A $filter of the rows changed in (after, until], by the bounds that jdbc.incremental_query takes; times without a zone are UTC."""

    def iso(text: str) -> str:
        time = datetime.fromisoformat(text)
        return (time if time.tzinfo else time.replace(tzinfo=timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    low, high = jdbc.bounds(after, until)
    return " and ".join(([f"({where})"] if where else []) + [f"{stamp} {sign} {iso(v)}" for sign, v in (("gt", low), ("le", high)) if v])


def between(stamp: Column, low: str | None, high: str | None) -> Column:
    """Client-side filter of records by time; those without one are kept."""
    out = F.lit(True)
    if low:
        out = out & (stamp.isNull() | (stamp >= low))
    if high:
        out = out & (stamp.isNull() | (stamp <= high))
    return out
