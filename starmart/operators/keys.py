"""Surrogate keys: dense numbers that a business key keeps once it has one."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits of the digest that name a bucket: 2 give 256 buckets, 4 give 65,536, for tables of billions of keys.
DIGITS = 2


def _digest(names: list[str]) -> Column:
    text = F.concat_ws("|", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names])
    return F.md5(text.cast("binary"))


def _bucket(business: list[str], every: list[str], digits: int) -> Column:
    """The first digits of a digest of the business key, or of the whole row where it has none: even buckets that no sample decides."""
    missing = reduce(and_, [F.col(name).isNull() for name in business])
    return F.substring(F.when(missing, _digest(every)).otherwise(_digest(business)), 1, digits)


def numbered(df: DataFrame, key: str, business: list[str], first: int = 0, digits: int = DIGITS) -> DataFrame:
    """Number the rows ``first``, ``first`` + 1, ... by bucket, then business key, then the other columns.

    A plan and nothing else: 16^``digits`` buckets are numbered side by side, and one row count per bucket says
    where each begins. The result depends on the rows alone, so a task that runs again
    gives the same keys; equal rows are interchangeable.
    """
    names = df.columns
    rest = [name for name in names if name not in business]
    placed = df.withColumn("_bucket", _bucket(business, names, digits))
    counts = placed.groupBy("_bucket").agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_bucket", F.coalesce(before, F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_bucket").orderBy(*business, *rest))
    number = (F.col("_start") + F.col("_place") - 1 + F.lit(first)).cast("long")
    return (
        placed.withColumn("_place", nth).join(F.broadcast(starts), "_bucket").select(number.alias(key), *names)
    )


def _occurrence(df: DataFrame, business: list[str]) -> DataFrame:
    """Rows that share a business key are told apart by their place among them."""
    rest = [name for name in df.columns if name not in business]
    order = [*business, *rest]
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*business).orderBy(*order)))


def _same(business: list[str]) -> Column:
    met = F.col("new._nth") == F.col("old._nth")
    for name in business:
        met = met & F.col(f"new.{name}").eqNullSafe(F.col(f"old.{name}"))
    return met


def occurrences(df: DataFrame, business: list[str]) -> DataFrame:
    return _occurrence(df, business).select(*business, "_nth")


def new_keys(df: DataFrame, key: str, business: list[str], known: DataFrame, highest: int | None) -> DataFrame:
    """Key rows (key, business key, _nth) for the business keys that ``known`` does not have, from ``highest`` + 1 on."""
    mine = occurrences(df, business).alias("new")
    fresh = mine.join(known.alias("old"), _same(business), "left_anti")
    return numbered(fresh, key, [*business, "_nth"], 0 if highest is None else highest + 1)


def with_keys(df: DataFrame, key: str, business: list[str], known: DataFrame) -> DataFrame:
    """The rows with the keys that ``known`` has for them."""
    names = df.columns
    met = _occurrence(df, business).alias("new").join(known.alias("old"), _same(business))
    return met.select(F.col(f"old.{key}").alias(key), *[F.col(f"new.{name}").alias(name) for name in names])
