"""Instants written as ISO-8601 text with differing offsets, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000


def micros(text: Column) -> Column:
    """Microseconds since the epoch; text without an offset counts as UTC, unreadable text gives null."""
    t = F.btrim(text)
    zoned = F.when(t.rlike(r"(?i)(z|[+-]\d{2}:?\d{2})$"), t).otherwise(F.concat(t, F.lit("Z")))
    return F.unix_micros(zoned.try_cast("timestamp"))


def month(us: Column) -> Column:
    """``yyyy-MM`` of an instant in microseconds, in UTC."""
    return F.date_format(F.date_from_unix_date(F.floor(us / DAY_MICROS).cast("int")), "yyyy-MM")
