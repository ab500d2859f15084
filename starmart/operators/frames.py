"""Cubes, and frames over time that no single task has to order as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.functions.measures import money_sum


def revenue_cube(df: DataFrame, levels: list[str], amount: str) -> DataFrame:
    """Revenue and rows of every combination of the levels, with all others taken together, from one scan.

    ``level_id`` has a bit for each level that is taken together, the last level's being 1. It tells a total (null because taken together)
    from the group of rows that have no value there.
    """
    return df.cube(*levels).agg(
        F.grouping_id().cast("int").alias("level_id"), money_sum(amount).alias("revenue"), F.count(F.lit(1)).alias("n_rows")
    )


def trailing_sum(df: DataFrame, key: list[str], day: str, amount: str, days: int) -> DataFrame:
    """key, day, revenue, trailing: revenue of each day with rows, and of the ``days`` days up to it.

    Rows become one per key and day before anything is ordered, so a task orders days, not rows. Rows without a day are left out.
    """
    daily = df.where(F.col(day).isNotNull()).groupBy(*key, day).agg(F.sum(F.col(amount).try_cast("decimal(18,2)")).alias("_sum"))
    frame = Window.partitionBy(*key).orderBy(F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))).rangeBetween(1 - days, 0)
    return daily.select(*key, day, F.col("_sum").cast("double").alias("revenue"), F.sum("_sum").over(frame).cast("double").alias("trailing"))


def running_total(df: DataFrame, key: list[str], ts: str, order: list[str], amount: str, bucket: str = "month") -> DataFrame:
    """The rows with ``running``: the sum of ``amount`` over the key's rows up to and including this one, by ``ts``, then ``order``.

    Two phases: rows are added up inside their bucket of time, and each bucket starts from the sum of those before it. So a key's rows are
    ordered bucket by bucket, in different tasks, and only one row per bucket is ordered over the whole key. Null amounts add nothing; rows without a
    time come first. ``order`` should make rows distinct; equal rows get the totals of some order among them.
    """
    cents = F.col(amount).try_cast("decimal(18,2)")
    placed = df.withColumn("_bucket", F.date_trunc(bucket, F.col(ts).cast("timestamp")))
    totals = placed.groupBy(*key, "_bucket").agg(F.sum(cents).alias("_total"))
    before = Window.partitionBy(*key).orderBy(F.col("_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(k).alias(f"_of_{k}") for k in key], F.col("_bucket").alias("_of_bucket"), F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(*key, "_bucket").orderBy(F.col(ts).asc_nulls_first(), *order).rowsBetween(Window.unboundedPreceding, 0)
    local = placed.withColumn("_local", F.coalesce(F.sum(cents).over(inside), F.lit(0)))
    same = F.col("_bucket").eqNullSafe(F.col("_of_bucket"))
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    return local.join(starts, same).select(*df.columns, (F.col("_start") + F.col("_local")).cast("double").alias("running"))
