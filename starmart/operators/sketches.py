"""Quality numbers of a long history from small sketches that are kept per load and merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2^12 registers: distinct counts with a standard error of 1.6 %.
REGISTERS = 12
#: Ranks of quantiles are off by 1.7 % at most, 99 times of 100.
ITEMS = 200


def load_sketches(df: DataFrame, load: str, keys: list[str], numbers: list[str]) -> DataFrame:
    """load_name, column_name, n_rows, n_null, distinct_sketch, quantile_sketch: one row per column, from one pass over a load.

    ``keys`` get a sketch of distinct values, ``numbers`` also one of quantiles (NaN counts as missing there). A sketch has some kilobytes, whatever the rows.
    """
    columns = [*keys, *numbers]

    def value(name: str) -> Column:
        return F.when(~F.isnan(F.col(name).cast("double")), F.col(name).cast("double"))

    row = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns],
        *[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(REGISTERS)).alias(f"d_{c}") for c in columns],
        *[F.kll_sketch_agg_double(value(c), F.lit(ITEMS)).alias(f"q_{c}") for c in numbers],
    )
    none = F.lit(None).cast("binary")
    parts = [
        F.struct(
            F.lit(load).alias("load_name"), F.lit(c).alias("column_name"), "n_rows", F.col(f"n_{c}").alias("n_null"),
            F.col(f"d_{c}").alias("distinct_sketch"), (F.col(f"q_{c}") if c in numbers else none).alias("quantile_sketch"),
        )
        for c in columns
    ]
    return row.select(F.inline(F.array(*parts)))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """column_name and one sketch for all loads: nothing but the sketches is read. Merging in any order or grouping gives the same sums."""
    return sketches.groupBy("column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def sketch_report(sketches: DataFrame, ranks: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """column_name, n_rows, n_null, n_distinct and a quantile for each rank (null for columns without numbers)."""
    known = F.kll_sketch_get_n_double("quantile_sketch") > 0
    merged = merged_sketches(sketches)
    quantiles = [
        F.when(known, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(rank))).alias(f"p{round(rank * 100):02d}") for rank in ranks
    ]
    return merged.select("column_name", "n_rows", "n_null", F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"), *quantiles)
