"""Strict timestamps and days. All days are UTC days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC3339 = (
    r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
)
_DAY = r"^\d{4}-\d{2}-\d{2}$"


def rfc3339(text: Column) -> Column:
    """TIMESTAMP of an RFC 3339 text; NULL if it is not one."""
    return F.when(text.rlike(RFC3339), F.upper(text).try_cast("timestamp"))


def format_rfc3339(at: Column) -> Column:
    return F.concat(
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
        # A fraction only where there is one.
        F.when(F.date_format(at, "SSSSSS") == "000000", F.lit("")).otherwise(
            F.concat(F.lit("."), F.rtrim(F.date_format(at, "SSSSSS"), F.lit("0")))
        ),
        F.lit("Z"),
    )


def strict_day(text: Column) -> Column:
    """DATE of a zero-padded yyyy-MM-dd text; NULL if it is not one."""
    return F.when(text.rlike(_DAY), text.try_cast("date"))


def report_end_day(as_of: Column, lag_days: Column) -> Column:
    """The last day whose report may be asked for: today minus a lag that is never negative."""
    return F.date_sub(F.to_date(as_of), F.greatest(lag_days, F.lit(0)).cast("int"))


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(days=F.lit(days))
