"""As-of join: to each row the latest row of another table that is not later."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: list[str],
    left_ts: str,
    right_ts: str,
    carry: list[str],
    ties: list[str] | None = None,
    bucket_seconds: int = DAY,
    tolerance_seconds: int | None = None,
) -> DataFrame:
    """All rows and columns of ``left``, and ``carry`` from the row of ``right`` with an equal key and the latest time up to the left row's.

    Among right rows of one time the greatest by ``ties`` (then by ``carry``) is taken. With a tolerance, right rows that are
    more seconds older count as none. Left rows without a key or time, or without a right row, get nulls; right rows without a key or time play no part.

    Both sides are laid on a grid of key and time bucket. Inside a cell the last right row is carried forward by a window; the last right
    row of each cell is carried to the later cells of its key. So one key's rows are spread over as many tasks as it has
    buckets, and only one row per cell is ever ordered over a whole key. ``carry`` must not name columns of ``left``.
    """
    names = left.columns
    clash = set(carry) & set(names)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")

    def micros(column: str):
        # Zoneless and zoned times become the same number.
        return F.unix_micros(F.col(column).cast("timestamp"))

    def cell(column: str):
        return F.floor(micros(column) / F.lit(bucket_seconds * 1_000_000))

    present = reduce(and_, [F.col(k).isNotNull() for k in key])
    held = F.struct(micros(right_ts).alias("_at"), *[F.col(t) for t in ties or []], *[F.col(c).alias(f"_{c}") for c in carry])
    facts = right.where(present & F.col(right_ts).isNotNull()).select(*key, cell(right_ts).alias("_cell"), held.alias("_held"))
    rows = left.select(*key, F.struct(*names).alias("_row"), micros(left_ts).alias("_time"), cell(left_ts).alias("_cell"))
    usable = present & F.col("_time").isNotNull()

    # The last right row of each cell, and of all cells before it that have rows of either side.
    cells = rows.where(usable).select(*key, "_cell", F.lit(None).cast(facts.schema["_held"].dataType).alias("_held")).unionByName(facts)
    last = cells.groupBy(*key, "_cell").agg(F.max("_held").alias("_held"))
    before = Window.partitionBy(*key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*key, "_cell", F.last("_held", ignorenulls=True).over(before).alias("_earlier")).where("_earlier is not null")

    together = rows.where(usable).withColumn("_side", F.lit(1)).unionByName(
        facts.withColumns({"_side": F.lit(0), "_time": F.col("_held._at")}), allowMissingColumns=True
    )
    inside = Window.partitionBy(*key, "_cell").orderBy("_time", "_side", "_held").rowsBetween(Window.unboundedPreceding, 0)
    local = together.withColumn("_held", F.last("_held", ignorenulls=True).over(inside)).where("_side = 1")
    met = local.join(carried, [*key, "_cell"], "left").withColumn("_held", F.coalesce("_held", "_earlier"))
    loose = rows.where(~F.coalesce(usable, F.lit(False))).withColumn("_held", F.lit(None).cast(facts.schema["_held"].dataType))
    both = met.select("_row", "_time", "_held").unionByName(loose.select("_row", "_time", "_held"))
    if tolerance_seconds is not None:
        near = F.col("_time") - F.col("_held._at") <= F.lit(tolerance_seconds * 1_000_000)
        both = both.withColumn("_held", F.when(near, F.col("_held")))
    return both.select(*[F.col(f"_row.{n}").alias(n) for n in names], *[F.col(f"_held._{c}").alias(c) for c in carry])
