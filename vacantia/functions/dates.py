"""Dates from postings as Column expressions. Unreadable values are null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, col

#: From here on an epoch number counts milliseconds.
MILLISECONDS = 100_000_000_000
_ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?\s*(Z|[+-]\d{2}:?\d{2})?)?$"


def from_epoch(number: Column) -> Column:
    """Timestamp of epoch seconds or milliseconds; null for zero, negative and unreachable numbers."""
    n = number.cast("double")
    seconds = F.when(n >= MILLISECONDS, n / 1000).otherwise(n)
    return F.when((n > 0) & (seconds < 253402300800), F.timestamp_micros((seconds * 1000000).cast("bigint")))


def to_timestamp(value: ColumnOrName) -> Column:
    """Timestamp of a text: digits are an epoch, else ISO 8601 with offset, or UTC without. Session time zone must be UTC."""
    text = F.trim(col(value).cast("string"))
    digits = text.rlike(r"^-*\d+$")
    return F.when(digits, from_epoch(F.when(digits, text).try_cast("double"))).when(text.rlike(_ISO), text.try_cast("timestamp"))


def to_iso(value: ColumnOrName) -> Column:
    return F.date_format(to_timestamp(value), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def to_day(value: ColumnOrName) -> Column:
    return F.date_format(to_timestamp(value), "yyyy-MM-dd")


def pick_date(*candidates: tuple[str, ColumnOrName]) -> Column:
    """struct<iso, source> of the first readable of (name, value) candidates; both null where none is."""
    found = F.coalesce(*[F.when(to_iso(c).isNotNull(), F.struct(to_iso(c).alias("iso"), F.lit(name).alias("source"))) for name, c in candidates])
    return F.coalesce(found, F.struct(F.lit(None).cast("string").alias("iso"), F.lit(None).cast("string").alias("source")))


def days_open(today: ColumnOrName, posted: ColumnOrName) -> Column:
    """Days from ``posted`` (its first ten characters) to ``today``, at least 0; null where unreadable."""
    days = F.date_diff(col(today).cast("date"), F.substring(col(posted).cast("string"), 1, 10).try_cast("date"))
    return F.when(days < 0, 0).otherwise(days)


def days_between(earlier: ColumnOrName, later: ColumnOrName) -> Column:
    """Days from ``earlier`` to ``later``; a date in the future is no age, so negative is null."""
    text = col(earlier).cast("string")
    days = F.date_diff(col(later).cast("date"), F.when(F.length(text) >= 10, F.substring(text, 1, 10)).try_cast("date"))
    return F.when(days >= 0, days)
