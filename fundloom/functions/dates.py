"""Dates and amounts as sources write them. "Today" is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundloom.functions.keys import strip


def us_date(c: Column) -> Column:
    """MM/DD/YYYY as ISO text; anything else is null."""
    return F.date_format(F.try_to_timestamp(strip(c), F.lit("MM/dd/yyyy")), "yyyy-MM-dd")


def millis_date(c: Column) -> Column:
    """Milliseconds since the epoch as a UTC date; zero and blank are null."""
    ms = c.cast("string").try_cast("bigint")
    return F.date_format(F.date_from_unix_date(F.floor(F.nullif(ms, F.lit(0)) / 86_400_000).cast("int")), "yyyy-MM-dd")


def term(c: Column) -> Column:
    """``struct(start, end)`` of "from Y" or "from Y to Y": first day of the first and last day of the last year."""
    text = F.lower(F.coalesce(c, F.lit("")))
    year = lambda word: F.nullif(F.regexp_extract(text, rf"\b{word}\s+([0-9]{{4}})", 1), F.lit(""))
    start = year("from")
    return F.struct(F.concat(start, F.lit("-01-01")).alias("start"), F.when(start.isNotNull(), F.concat(year("to"), F.lit("-12-31"))).alias("end"))


def month_span(month: Column, months: Column) -> Column:
    """``struct(start, end)``: first of a YYYY-MM month, and that many months later."""
    start = F.try_to_date(F.concat(F.regexp_extract(strip(month), r"^(\d{4}-\d{2})", 1), F.lit("-01")), "yyyy-MM-dd")
    n = strip(months.cast("string")).try_cast("double").cast("int")
    return F.struct(F.date_format(start, "yyyy-MM-dd").alias("start"), F.date_format(F.add_months(start, n), "yyyy-MM-dd").alias("end"))


def first_ten(c: Column) -> Column:
    """The first ten characters, unvalidated; blank is null."""
    return F.nullif(F.substring(strip(c), 1, 10), F.lit(""))


def year_start(c: Column) -> Column:
    y = strip(c.cast("string")).try_cast("int")
    return F.when(y.between(1, 9999), F.concat(F.lpad(y.cast("string"), 4, "0"), F.lit("-01-01")))


def status_by_end(end: Column, today: str) -> Column:
    """Active until the end date, completed after it, unknown without one."""
    return F.when(end.isNull(), "unknown").when(end >= today, "active").otherwise("completed")


def status_word(c: Column) -> Column:
    w = F.upper(strip(c))
    return F.when(w.isin("SIGNED", "ONGOING"), "active").when(w.isin("CLOSED", "TERMINATED"), "completed").otherwise(F.nullif(F.lower(w), F.lit("")))


def month_windows(first: Column, last: Column) -> Column:
    """Array of ``struct(start, end)``, the first and last day of each month that ``first`` to ``last`` touch, newest first."""
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return F.transform(F.reverse(months), lambda m: F.struct(F.date_format(m, "yyyy-MM-dd").alias("start"), F.date_format(F.last_day(m), "yyyy-MM-dd").alias("end")))


def positive(c: Column) -> Column:
    x = strip(c.cast("string")).try_cast("double")
    return F.when(x > 0, x)


def decimal_comma(c: Column) -> Column:
    """Amounts with a comma as decimal sign where there is no point, as thousands sign where there is one."""
    s = F.regexp_replace(strip(c.cast("string")), r"[€\s]", "")
    return positive(F.when(s.contains(",") & ~s.contains("."), F.replace(s, F.lit(","), F.lit("."))).otherwise(F.replace(s, F.lit(","), F.lit(""))))


def decimal_point(c: Column) -> Column:
    """Amounts with commas as thousands signs and a currency sign in front."""
    return positive(F.regexp_replace(strip(c.cast("string")), r"[,$£\s]", ""))


def first_amount(*columns: Column) -> Column:
    """The first of several amounts that is more than nothing."""
    return F.coalesce(*[positive(c) for c in columns])


def lat_lon(c: Column) -> Column:
    p = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), r"[()\s]", ""), ",")
    lat, lon = (F.get(p, F.lit(i)).try_cast("double") for i in (0, 1))
    both = (F.size(p) == 2) & lat.isNotNull() & lon.isNotNull()
    return F.struct(F.when(both, lat).alias("lat"), F.when(both, lon).alias("lon"))
