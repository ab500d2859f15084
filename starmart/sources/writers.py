"""Parquet, CSV and JDBC sinks, and counts taken during a write."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

LOG = logging.getLogger("starmart")


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def create_if_missing(df: DataFrame, path: str, *names: str) -> None:
    """Make an empty table with the columns of ``df``; leave an existing one alone."""
    df.limit(0).write.mode("ignore").partitionBy(*names).parquet(path)


def overwrite_partitioned(df: DataFrame, path: str, *names: str) -> None:
    """For reports: the few rows are already in as few tasks as there are directories."""
    df.write.mode("overwrite").partitionBy(*names).parquet(path)


def append_partitioned(df: DataFrame, path: str, *names: str) -> None:
    """Append into one directory per value of ``names``.

    The rebalance hint brings rows of a directory together, so few files result, and lets AQE
    cut a directory that holds far more rows than the others into several tasks.
    """
    df.hint("rebalance", *names).write.mode("append").partitionBy(*names).parquet(path)


def write_csv_report(df: DataFrame, path: str) -> None:
    """CSV with header, in the order of the sorted ``df``: files follow each other by name.

    A report of a few megabytes is one file, as Spark merges small partitions after the sort; a
    larger one is several, and no task gets them all.
    """
    df.write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, bytes_per_file: int = 128 << 20) -> None:
    """CSV of any size with every field quoted, so that line breaks and quotes survive.

    Files are bounded, for readers that read a file with line breaks in quotes by one task: the mean size of a row, from a
    pass over the columns, says how many rows make ``bytes_per_file``.
    """
    mean = df.agg(F.avg(F.octet_length(F.to_csv(F.struct("*"))) + 2 * len(df.columns))).first()[0]
    rows_per_file = max(1, int(bytes_per_file / mean)) if mean else 1
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows (and take other metrics) in the pass that writes ``df``.

    Counts are for the log: they can come out high if a stage is run again after a lost executor.
    """
    taken = Observation(name)
    return df.observe(taken, F.count(F.lit(1)).alias("rows"), *metrics), taken


def logged(name: str, df: DataFrame, rows: int) -> int:
    """Log a table's rows and schema once it is written; the rows."""
    LOG.info("%s: %d rows\n%s", name, rows, df.schema.treeString())
    return rows


@dataclass(frozen=True)
class JdbcTarget:
    """Where the star goes. User and password come from the environment, never from code.

    Spark merges the partitions of a larger table to ``connections`` tasks, which is how many write at once.
    """

    url: str
    driver: str = "org.postgresql.Driver"
    connections: int = 16
    batch_rows: int = 10_000
    user_variable: str = "STARMART_JDBC_USER"
    password_variable: str = "STARMART_JDBC_PASSWORD"

    def options(self, table: str) -> dict[str, str]:
        found = {
            "url": self.url,
            "dbtable": table,
            "driver": self.driver,
            "numPartitions": str(self.connections),
            "batchsize": str(self.batch_rows),
            "truncate": "true",
        }
        for option, variable in (
            ("user", self.user_variable),
            ("password", self.password_variable),
        ):
            if variable in os.environ:
                found[option] = os.environ[variable]
        return found


def overwrite_jdbc(df: DataFrame, target: JdbcTarget, table: str) -> None:
    """Replace the rows and keep the table definition; executors write in parallel."""
    df.write.format("jdbc").options(**target.options(table)).mode("overwrite").save()
