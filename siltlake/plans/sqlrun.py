"""Running scripts of several SQL statements."""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from siltlake.sinks import tables

#: Comments, quoted text, a statement's end, or anything else.
PIECE = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|;|[^-/'\"`;]+|.", re.S)


def statements(script: str) -> list[str]:
    """The script's statements without comments; semicolons in quotes do not end one."""
    out, now = [], ""
    for m in PIECE.finditer(script):
        piece = m.group()
        if piece == ";":
            out.append(now)
            now = ""
        elif not piece.startswith(("--", "/*")):
            now += piece
    return [s.strip() for s in (*out, now) if s.strip()]


def fill(script: str, names: Mapping[str, str]) -> str:
    """Replaces ${name} and {{name}} by identifiers; values belong in parameters (:name) instead."""
    for k, v in names.items():
        if not re.fullmatch(r"[\w.`-]+", v):
            raise ValueError(f"{v!r} is no identifier")
        script = script.replace("${" + k + "}", v).replace("{{" + k + "}}", v)
    return script


class Watch:
    """Ends what a statement runs once its time is over: its jobs carry a tag, by which any thread can cancel them (a session's tags are known to their own thread alone)."""

    def __init__(self, spark: SparkSession, seconds: float | None):
        self.context, self.seconds, self.tag, self.over = spark.sparkContext, seconds, f"sql-{uuid.uuid4().hex}", False

    def __enter__(self) -> Watch:
        self.context.addJobTag(self.tag)
        self.timer = threading.Timer(self.seconds, self.interrupt) if self.seconds else None
        if self.timer:
            self.timer.daemon = True
            self.timer.start()
        return self

    def interrupt(self) -> None:
        self.over = True
        # Again and again: a statement may be between two jobs.
        while self.over:
            self.context.cancelJobsWithTag(self.tag)
            time.sleep(0.2)

    def __exit__(self, *_) -> None:
        if self.timer:
            self.timer.cancel()
        self.ended, self.over = self.over, False
        self.context.removeJobTag(self.tag)


class StatementError(RuntimeError):
    """A statement that failed; `index` counts from 1."""

    def __init__(self, index: int, why: str, statement: str):
        super().__init__(f"statement {index} {why}: {statement[:200]}")
        self.index = index


class StatementTimeout(StatementError, TimeoutError):
    pass


def run(spark: SparkSession, script: str, values: Mapping[str, object] | None = None, names: Mapping[str, str] | None = None, most: int | None = None, seconds: float | None = None) -> DataFrame | None:
    """Runs all statements and gives the last one's result, cut to `most` rows if that is positive.

    With `seconds` no statement may take longer: its jobs are cancelled, the rest of the script does not run, and the error tells which
    it was. The last result is then written to a folder that all executors share, within its time, and read from there, as a query runs only when its rows are asked for.
    """
    result = None
    found = statements(fill(script, names or {}))
    for n, statement in enumerate(found, 1):
        used = {k: v for k, v in (values or {}).items() if re.search(rf":{k}\b", statement)}
        watch = Watch(spark, seconds)
        try:
            with watch:
                result = spark.sql(statement, args=used) if used else spark.sql(statement)
                if n == len(found):
                    result = result.limit(most) if most and most > 0 else result
                    if seconds and result.columns:
                        where = tables.scratch(spark, "result")
                        result.write.parquet(where)
                        result = spark.read.schema(result.schema).parquet(where)
        except Exception as e:
            if watch.ended:
                raise StatementTimeout(n, f"took more than {seconds:g} seconds", statement) from e
            raise StatementError(n, "failed", statement) from e
    return result
