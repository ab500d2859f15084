"""Calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_parts(name: str) -> dict[str, Column]:
    at = F.col(name)
    return {
        "year": F.year(at),
        "month": F.month(at),
        "quarter": F.quarter(at),
        "day": F.dayofmonth(at),
    }


def calendar_day(name: str) -> Column:
    return F.to_date(F.col(name))


def days_between(start: str, end: str) -> Column:
    """Calendar days; the time of day does not count. Null if either end is null."""
    return F.datediff(F.col(end), F.col(start))


def date_key(name: str) -> Column:
    """yyyyMMdd as a long."""
    return F.date_format(F.col(name), "yyyyMMdd").cast("long")


def month_name(name: str) -> Column:
    return F.date_format(F.col(name), "MMMM")


def weekday_name(name: str) -> Column:
    return F.date_format(F.col(name), "EEEE")


def is_weekend(name: str) -> Column:
    """Spark numbers the week from Sunday = 1 to Saturday = 7."""
    return F.when(F.dayofweek(F.col(name)).isin(1, 7), 1).otherwise(0)
