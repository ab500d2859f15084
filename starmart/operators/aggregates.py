"""Grouped measures. All use partial aggregation, so hot keys shrink before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions.measures import money_sum


def centroid(df: DataFrame, keys: list[str], lat: str, lng: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(lat).alias("avg_lat"), F.avg(lng).alias("avg_lng"))


def amount_by(df: DataFrame, key: str, amount: str) -> DataFrame:
    return df.groupBy(key).agg(money_sum(amount).alias(amount))


def average_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(value))


def latest(df: DataFrame, ts: str, alias: str) -> DataFrame:
    return df.agg(F.max(ts).alias(alias))


def monthly_revenue(df: DataFrame, amount: str = "price") -> DataFrame:
    """Revenue per year and month in calendar order."""
    return (
        df.groupBy("year", "month")
        .agg(money_sum(amount).alias("revenue"))
        .orderBy("year", "month")
    )


def first_rows(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """Top rows in a fixed order; Spark keeps n rows per task and merges them."""
    return df.orderBy(*order_by).limit(n)
