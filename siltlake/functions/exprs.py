"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The sentinel that closes open validity, and strings that stand for null.
HIGH_DATE = "9999-01-01 00:00:00"
NULL_LIKE = ("", "null", "none", "nan", "undefined")
#: Formats tried in order when a timestamp is conformed; month first before day first.
FORMATS = (
    "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd",
    "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy",
    "dd/MM/yyyy HH:mm:ss", "dd/MM/yyyy HH:mm", "dd/MM/yyyy", "dd-MM-yyyy HH:mm:ss", "dd-MM-yyyy",
)
#: Numbers taken for epoch seconds and for epoch milliseconds, both ends included.
EPOCH_SECONDS, EPOCH_MILLIS = (1e8, 3e10), (1e11, 3e12)
ISO = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2})(\.\d+)?(Z|[+-]\d{2}:?\d{2})?$"


def std_timestamp(value: Column) -> Column:
    """ISO timestamps as `yyyy-MM-dd HH:mm:ss`; fraction and offset are dropped, not converted. Others stay."""
    text = value.cast("string")
    return F.when(text.rlike(ISO), F.regexp_replace(text, ISO, "$1 $2")).otherwise(text)


def sign_of(pattern: str) -> str:
    """The sign that parts a format's date."""
    return "/" if "/" in pattern else "-"


def conform_number(value: Column) -> Column:
    """Epoch seconds or milliseconds, told apart by their size, as `yyyy-MM-dd HH:mm:ss` text; other numbers stay, as text."""
    number = value.cast("double")
    seconds = F.when(number.between(*EPOCH_MILLIS), number / 1000).when(number.between(*EPOCH_SECONDS), number)
    return F.coalesce(F.date_format(F.timestamp_seconds(F.floor(seconds)), "yyyy-MM-dd HH:mm:ss"), value.cast("string"))


def conform_timestamp(value: Column, kind: T.DataType | None = None) -> Column:
    """Text in any known format, or epoch seconds or milliseconds, as `yyyy-MM-dd HH:mm:ss` text.

    Strings that stand for null become null; what no format fits stays, trimmed. kind is the column's type, text if
    not given: numbers are epochs by their range, times and dates are shown.
    """
    if isinstance(kind, T.NumericType):
        return conform_number(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    text = F.trim(value.cast("string"))
    iso = F.regexp_extract(text, ISO, 1)
    # A format is tried on text of its shape alone: as long as it is, with its first sign where it stands.
    fits = lambda f: (F.length(text) == len(f.replace("'", ""))) & (F.substring(text, f.find(sign_of(f)) + 1, 1) == sign_of(f))
    parsed = F.coalesce(
        F.when(iso != "", F.try_to_timestamp(F.regexp_replace(text, ISO, "$1 $2"), F.lit(FORMATS[0]))),
        F.when(text.rlike(r"^\d{13}$"), F.timestamp_millis(text.try_cast("bigint"))),
        F.when(text.rlike(r"^\d{10}$"), F.timestamp_seconds(text.try_cast("bigint"))),
        *[F.when(fits(f), F.try_to_timestamp(text, F.lit(f))) for f in FORMATS],
    )
    shown = F.coalesce(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"), text)
    return F.when(F.lower(text).isin(*NULL_LIKE), F.lit(None).cast("string")).otherwise(shown)


def payload_hash(columns: Sequence[str]) -> Column:
    """SHA-256 over the columns' text in order of name."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("<NULL>")) for c in sorted(columns)]
    return F.sha2(F.concat_ws("||", *shown) if shown else F.lit(""), 256)


def yes_no(value: Column) -> Column:
    """`Y` for Y, TRUE and 1 in any case, else `N`."""
    return F.when(F.upper(F.trim(value.cast("string"))).isin("Y", "TRUE", "1"), "Y").otherwise("N")


def nonblank(value: Column) -> Column:
    return value.isNotNull() & (F.trim(value) != "")


def active() -> Column:
    """The row is current and not deleted."""
    return (F.col("_is_current") == "Y") & (F.col("_is_deleted") == "N")


def distinct_list(value: Column, separator: str = ", ") -> Column:
    """An aggregate: the distinct values in order, joined; nulls are skipped, and none give an empty string."""
    return F.array_join(F.array_sort(F.collect_set(value)), separator)


def ordered_list(order: Column, value: Column, separator: str = "; ") -> Column:
    """An aggregate: all values in the given order, joined."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x.v), separator)
