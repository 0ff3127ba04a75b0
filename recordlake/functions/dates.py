"""Periods, date formats and validity dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

OPEN_END = "2099-12-31"
#: Pattern, name of the format, and the same format for Spark; the first that fits and is a date holds.
FORMATS = (
    (r"^\d{4}-\d{2}-\d{2}$", "%Y-%m-%d", "yyyy-MM-dd"),
    (r"^\d{4}/\d{2}/\d{2}$", "%Y/%m/%d", "yyyy/MM/dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "%m/%d/%Y", "MM/dd/yyyy"),
    (r"^\d{2}-\d{2}-\d{4}$", "%m-%d-%Y", "MM-dd-yyyy"),
    (r"^\d{8}$", "%Y%m%d", "yyyyMMdd"),
    (r"^\d{6}$", "%Y%m", "yyyyMM"),
    (r"^\d{14}$", "%Y%m%d%H%M%S", "yyyyMMddHHmmss"),
)
MONTHS = {"monthly": 1, "quarterly": 3, "yearly": 12}
UNITS = {"monthly": "month", "quarterly": "quarter", "yearly": "year"}


def date_format_of(c: str | Column) -> Column:
    """Name of the format of a date string; null if it has none."""
    text = col(c)
    return F.coalesce(*[F.when(text.rlike(p) & F.try_to_timestamp(text, F.lit(java)).isNotNull(), F.lit(name)) for p, name, java in FORMATS])


def period_date(text: str | Column, fmt: str) -> Column:
    """Date of a period string in a format of FORMATS; null if it is not one."""
    java = {name: j for _, name, j in FORMATS}[fmt]
    return F.try_to_timestamp(col(text), F.lit(java)).cast("date")


def known_date(text: str | Column) -> Column:
    """Date of a text in the first of FORMATS that it is in; null for null or empty, and an error for what is in none."""
    c = F.trim(col(text))
    found = F.coalesce(*[F.when(c.rlike(p), F.try_to_timestamp(c, F.lit(java)).cast("date")) for p, _, java in FORMATS])
    none = c.isNull() | (c == "")
    return F.when(~none, F.coalesce(found, F.raise_error(F.concat(F.lit("not a date: "), c)).cast("date")))


def period_end(d: str | Column, frequency: str, first: bool = False) -> Column:
    """First or last day of the month, quarter or year of a date."""
    start = F.date_trunc(UNITS[frequency], col(d)).cast("date")
    return start if first else F.date_sub(F.add_months(start, MONTHS[frequency]), 1)


def period_suffix(d: str | Column, fmt: str, frequency: str, first: bool = False) -> Column:
    java = {name: j for _, name, j in FORMATS}[fmt]
    return F.date_format(period_end(d, frequency, first), java)


def file_period(file_name: str | Column, series: str | Column, fmt: str) -> Column:
    """Date of the period in a file name series_period.extension."""
    stem = F.regexp_replace(col(file_name), r"\.[^.]*$", "")
    return period_date(F.substring(stem, F.length(col(series)) + F.lit(2), F.length(stem)), fmt)


def validity_dates(file_name: str | Column) -> tuple[Column, Column]:
    """(from, to) in the last brackets of a layout's name, as in (Sep 2013 - Nov 2013); Present is OPEN_END; else nulls."""
    name = col(file_name)
    inner = F.when(name.contains("("), F.substring_index(F.substring_index(name, "(", -1), ")", 1))
    left, right = F.trim(F.substring_index(inner, "-", 1)), F.trim(F.regexp_extract(inner, r"^[^-]*-(.*)$", 1))

    def parsed(c: Column) -> Column:
        tries = [F.try_to_timestamp(c, F.lit(f)).cast("date") for f in ("MMM yyyy", "MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "yyyy-MM-dd")]
        return F.when(F.lower(c) == "present", F.lit(OPEN_END).cast("date")).otherwise(F.coalesce(*tries))

    both = inner.contains("-")
    a, b = F.when(both, parsed(left)), F.when(both, parsed(right))
    whole = a.isNotNull() & b.isNotNull()
    return F.when(whole, a), F.when(whole, b)


def clamp_end(d: str | Column, as_of: Column) -> Column:
    """An open end becomes the day of the analysis."""
    return F.when(col(d) >= F.lit("2099-01-01").cast("date"), as_of).otherwise(col(d))


def months_between(start: str | Column, end: str | Column) -> Column:
    """First days of all months from start to end; empty if end is before start."""
    a, b = F.trunc(col(start), "month"), F.trunc(col(end), "month")
    return F.when(a <= b, F.sequence(a, b, F.expr("interval 1 month"))).otherwise(F.array().cast("array<date>"))


def month_label(start: str | Column, end: str | Column | None = None) -> Column:
    """yyyy-MM, or a to b for a run of months."""
    a = F.date_format(col(start), "yyyy-MM")
    if end is None:
        return a
    b = F.date_format(col(end), "yyyy-MM")
    return F.when(a == b, a).otherwise(F.concat(a, F.lit(" to "), b))
