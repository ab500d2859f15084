"""Row filters and exact dedupe. A null in a comparison drops the row unless stated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def drop_exact_copies(df: DataFrame) -> DataFrame:
    """Whole-row dedupe. Copies collapse in each map task before the shuffle."""
    return df.dropDuplicates()


def require(df: DataFrame, *names: str) -> DataFrame:
    """Keep rows where every named column is present; NaN counts as missing.

    The same rows as ``na.drop(subset=names)``, written as null tests that reach file statistics.
    """
    for name in names:
        df = df.filter(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            df = df.filter(~F.isnan(name))
    return df


def not_null(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNotNull())


def positive(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name) > 0)


def not_negative(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name) >= 0)


def in_range(df: DataFrame, name: str, low: int, high: int) -> DataFrame:
    """Both ends included."""
    return df.filter(F.col(name).between(low, high))


def null_or_not_negative(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNull() | (F.col(name) >= 0))
