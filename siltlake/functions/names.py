"""Names of columns and tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Columns that always hold timestamps, endings and beginnings that suggest one, and audit columns.
TIMESTAMPS = {"timestamp", "datetime", "created", "updated", "event_ts"}
ENDINGS = ("_at", "_time", "_date", "_on", "_ts", "_start", "_end", "_timestamp", "_datetime")
BEGINNINGS = ("date_", "time_", "timestamp_")
AUDIT = ("_valid_from", "_valid_to", "_is_current", "_is_deleted", "_inserted_at", "_updated_at")
TECHNICAL = {*AUDIT, "_data_as_of"}


def sanitise(header: str) -> str:
    """A header as a snake-case column name."""
    name = re.sub(r"_+", "_", re.sub(r"[^0-9a-z]+", "_", header.strip().lower())).strip("_")
    if not name:
        return "unnamed_column"
    return f"col_{name}" if name[0].isdigit() else name


def sanitised(df: DataFrame) -> DataFrame:
    """df under sanitised names; a name that comes twice gets a number."""
    names: list[str] = []
    for column in df.columns:
        name, n = sanitise(column), 2
        while name in names:
            name, n = f"{sanitise(column)}_{n}", n + 1
        names.append(name)
    return df.toDF(*names)


def timestamp_like(name: str, kind: T.DataType | None = None) -> bool:
    """Whether a column holds timestamps, by type or else by name."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return True
    low = name.lower()
    return low not in TECHNICAL and (low in TIMESTAMPS or low.endswith(ENDINGS) or low.startswith(BEGINNINGS))


def base_name(table: str, prefixes: tuple[str, ...] = ("raw_tbl_", "tbl_")) -> str:
    """The table's name in lower case without any of the prefixes, however often they stand."""
    name = table.lower().replace("-", "_")
    while hit := next((p for p in prefixes if name.startswith(p)), None):
        name = name[len(hit) :]
    return name


def payload(columns: list[str], keys: list[str]) -> list[str]:
    """Columns that carry a row's content: no key, no technical name."""
    return sorted(c for c in columns if c not in keys and c not in TECHNICAL and not c.startswith("_"))
