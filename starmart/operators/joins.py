"""Left outer joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def left_join(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Left outer equi-join without hints, for lookups and for order-grain tables.

    Spark checks the size of the right side, from file statistics before it starts and from
    shuffle statistics while it runs. Up to spark.sql.autoBroadcastJoinThreshold it broadcasts it:
    the left side then is not shuffled and a hot key does no harm. Above that it shuffles
    both sides, and AQE splits a left partition that holds a hot key over several tasks.
    """
    return left.join(right, on, "left")
