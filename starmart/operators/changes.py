"""What differs between two versions of a table, as multisets of rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

INSERT, DELETE, OLD, NEW = "insert", "delete", "update_old", "update_new"


def row_changes(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """change, copies and the columns of ``before``: the rows that one version has more often than the other.

    ``insert`` and ``delete`` are rows whose key the other version doesn't have at all; where both have the key, rows that went are
    ``update_old`` and rows that came ``update_new``. ``copies`` is by how many the row came or went, so a row
    that stands twice and then once is one ``update_old``. Nulls are equal to each other, in keys too.

    Equal rows of both versions meet in one grouping by all columns, with partial sums in front of the shuffle: unchanged rows
    collapse there, and a key with many rows is spread. Only changed rows meet the counts of their key.
    """
    names = before.columns
    sides = before.select(*names, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        after.select(*names, F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    counted = sides.groupBy(*names).agg(F.sum("_old").alias("_old"), F.sum("_new").alias("_new"))
    changed = counted.where("_old <> _new").alias("c")
    held = counted.groupBy(*key).agg(F.sum("_old").alias("_all_old"), F.sum("_new").alias("_all_new")).alias("h")
    met = changed.join(held, reduce(and_, [F.col(f"c.{k}").eqNullSafe(F.col(f"h.{k}")) for k in key]))
    kind = (
        F.when(F.col("_all_old") == 0, INSERT)
        .when(F.col("_all_new") == 0, DELETE)
        .when(F.col("_new") < F.col("_old"), OLD)
        .otherwise(NEW)
    )
    return met.select(kind.alias("change"), F.abs(F.col("_new") - F.col("_old")).alias("copies"), *[F.col(f"c.{n}").alias(n) for n in names])
