"""Join of intervals that overlap, as an equi-join on cells of a grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Each level's cells are so many times as wide as those of the level below.
STEP = 8


def _places(df: DataFrame, side: str, start: Column, end: Column, base: int, levels: int) -> DataFrame:
    """_level: the first whose cells are as wide as the interval, so that it touches two cells at most; _low and _high: its ends."""
    length = F.col(f"_{side}_high") - F.col(f"_{side}_low")
    level = F.lit(levels - 1)
    for k in reversed(range(levels - 1)):
        level = F.when(length < base * STEP**k, F.lit(k)).otherwise(level)
    whole = df.select(F.struct("*").alias(f"_{side}"), start.alias(f"_{side}_low"), end.alias(f"_{side}_high"))
    return whole.where((F.col(f"_{side}_low") < F.col(f"_{side}_high"))).withColumn(f"_{side}_level", level)


def _cells(low: Column, high: Column, width: Column) -> Column:
    return F.sequence(F.floor(low / width), F.floor((high - 1) / width))


def _width(level: Column, base: int) -> Column:
    return F.lit(base) * F.pow(F.lit(STEP), level).cast("long")


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_ends: tuple[str, str],
    right_ends: tuple[str, str],
    key: list[str] | None = None,
    base: int = 3_600_000_000,
    levels: int = 8,
) -> DataFrame:
    """left, right: pairs of rows, as structs, with equal keys whose intervals overlap.

    Ends are whole numbers or times, taken as microseconds; an interval holds its start but not its end. Empty, reversed and open (null)
    intervals overlap nothing. ``base`` is the width of the finest cells.

    An interval lies in cells as wide as itself, two at most, and also in the wider cells around them at every coarser
    level. Two intervals meet at the level of the longer one: its own cells on one side, the wider cells on the
    other. They may meet in two cells, of which the one that holds the later start counts, so no pair comes twice and nothing has to be made distinct.
    Intervals longer than the coarsest cells lie in as many of these as they touch.
    """

    def micros(df: DataFrame, column: str) -> Column:
        kind = df.schema[column].dataType.typeName()
        return F.unix_micros(F.col(column).cast("timestamp")) if kind.startswith("timestamp") else F.col(column).cast("long")

    sides = {
        side: _places(df, side, *[micros(df, c) for c in ends], base, levels)
        for side, df, ends in (("l", left, left_ends), ("r", right, right_ends))
    }

    def own(side: str) -> DataFrame:
        level = F.col(f"_{side}_level")
        return sides[side].withColumn("_at", level).withColumn("_cell", F.explode(_cells(F.col(f"_{side}_low"), F.col(f"_{side}_high"), _width(level, base))))

    def wider(side: str, with_own: bool) -> DataFrame:
        first = F.col(f"_{side}_level") + (0 if with_own else 1)
        up = F.when(first < levels, F.sequence(first, F.lit(levels - 1))).otherwise(F.array().cast("array<int>"))
        placed = sides[side].withColumn("_at", F.explode(up))
        return placed.withColumn("_cell", F.explode(_cells(F.col(f"_{side}_low"), F.col(f"_{side}_high"), _width(F.col("_at"), base))))

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        on = (F.col("a._at") == F.col("b._at")) & (F.col("a._cell") == F.col("b._cell"))
        for name in key or []:
            on = on & (F.col(f"a._l.{name}") == F.col(f"b._r.{name}"))
        later = F.greatest("a._l_low", "b._r_low")
        once = F.floor(later / _width(F.col("a._at"), base)) == F.col("a._cell")
        overlap = (F.col("a._l_low") < F.col("b._r_high")) & (F.col("b._r_low") < F.col("a._l_high"))
        return a.alias("a").join(b.alias("b"), on & overlap & once).select(F.col("a._l").alias("left"), F.col("b._r").alias("right"))

    return met(wider("l", True), own("r")).unionAll(met(own("l"), wider("r", False)))
