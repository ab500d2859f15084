"""High-water marks: how far each source table has been loaded.

One directory per table (``table_name=…``), so setting a mark rewrites that table's row only.

A mark in Python is wall-clock time in the zone of the session (UTC in ours), whatever the zone of
the Python process; it crosses over as a zoneless timestamp.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from starmart.sources.readers import read_parquet
from starmart.sources.schemas import CONTROL

# Fixed values
START = datetime(1900, 1, 1)
TABLES = ("orders", "reviews", "order_items")


def wall_clock(ts: Column) -> Column:
    """A timestamp as it is to be collected."""
    return ts.cast("timestamp_ntz")


def _rows(spark: SparkSession, marks: list[tuple[str, datetime]]) -> DataFrameWriter:
    """The marks as literals of one task, so that no Python worker starts for a few rows."""
    literals = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(ts.isoformat(sep=" ")).cast("timestamp").alias("last_processed_ts"),
        )
        for table, ts in marks
    ]
    one = spark.range(0, 1, 1, 1).select(F.inline(F.array(*literals)))
    return one.write.partitionBy("table_name")


def init_marks(
    spark: SparkSession, path: str, tables: tuple[str, ...] = TABLES, keep: bool = False
) -> None:
    """Start over with every table at 1900-01-01, or with ``keep`` only where nothing exists yet."""
    fresh = _rows(spark, [(table, START) for table in tables])
    fresh.mode("ignore" if keep else "overwrite").parquet(path)


def set_mark(spark: SparkSession, path: str, table: str, ts: datetime) -> None:
    """Set or reset one mark; the others stay."""
    one = _rows(spark, [(table, ts)]).option("partitionOverwriteMode", "dynamic")
    one.mode("overwrite").parquet(path)


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, CONTROL).select(*CONTROL.names)


def mark_of(marks: DataFrame, table: str) -> DataFrame:
    return marks.filter(F.col("table_name") == table).select("last_processed_ts")


def get_mark(spark: SparkSession, path: str, table: str) -> datetime:
    """The mark of a table, or the start value if it has none."""
    marks = mark_of(read_marks(spark, path), table)
    row = marks.select(wall_clock(F.col("last_processed_ts"))).first()
    return row[0] if row and row[0] else START


def after_mark(df: DataFrame, ts: str, mark: datetime) -> DataFrame:
    """Rows strictly after the mark. Null timestamps are dropped.

    The mark takes the type of the column, not the other way round, so that the filter
    reaches the file statistics of zoneless timestamps too.
    """
    bound = F.lit(mark.isoformat(sep=" ")).cast(df.schema[ts].dataType)
    return df.filter(F.col(ts) > bound)
