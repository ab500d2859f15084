"""Reading, staging and iteration helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_path


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: Spark's own setting: the files of a query's shuffles go when it ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the shared folder and read back: cut lineage that survives a lost executor.

    `df` itself is not run again, so the shuffles of the write are of no more use.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    made = spark.read.schema(df.schema).parquet(path)
    made.staged_path = path
    for kept in _RECORDS:
        kept.append(path)
    return made


_RECORDS: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Adds the folders that are staged meanwhile to ``paths``, so that they can be removed when what was built on them is written."""
    _RECORDS.append(paths)
    try:
        yield
    finally:
        _RECORDS.remove(paths)


def discard(*tables: DataFrame) -> None:
    """Remove staged tables that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df.staged_path)


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch; None gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            made = work(batch)
            if made is not None and made.num_rows:
                yield made

    return df.mapInArrow(run, schema)


def crc_of_id(column: str):
    """crc32 of an id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))
