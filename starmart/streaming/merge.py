"""Bringing a target to a newer version of its rows: changed and vanished rows too, which a load mark never sees."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.changes import DELETE, OLD, row_changes
from starmart.session import scratch_path
from starmart.sources.readers import read_parquet
from starmart.sources.writers import create_if_missing, overwrite_parquet


def merge_snapshot(
    spark: SparkSession,
    rows: DataFrame,
    *,
    key: list[str],
    target_path: str,
    partition_by: tuple[str, ...] = (),
    delete_missing: bool = True,
) -> dict[str, int]:
    """Make the target hold ``rows``; how many rows were inserted, deleted, and replaced (``update_old``, ``update_new``).

    Only directories with a changed row are written again. Without ``delete_missing`` rows whose key ``rows`` doesn't have stay, for sources that
    hold a part of the table. Columns of type map can't be compared. A second run after a crash starts from what it finds and ends the same.
    """
    create_if_missing(rows, target_path, *partition_by)
    target = read_parquet(spark, target_path, rows.schema).select(*rows.columns)
    path = scratch_path(spark, "changes")
    overwrite_parquet(row_changes(target, rows, key), path)
    changes = read_parquet(spark, path)
    counts = {r["change"]: r["n"] for r in changes.groupBy("change").agg(F.sum("copies").alias("n")).collect()}
    if not delete_missing:
        changes = changes.where(F.col("change") != DELETE)
    if not set(counts) - (set() if delete_missing else {DELETE}):
        return counts

    names = rows.columns
    touched = target
    if partition_by:
        places = changes.select(*partition_by).distinct()
        same = [F.col(f"t.{p}").eqNullSafe(F.col(f"p.{p}")) for p in partition_by]
        touched = target.alias("t").join(places.alias("p"), same, "left_semi")
    gone = F.when(F.col("change").isin(DELETE, OLD), -F.col("copies")).otherwise(F.col("copies"))
    signed = touched.select(*names, F.lit(1).cast("long").alias("_n")).unionByName(changes.select(*names, gone.alias("_n")))
    left = signed.groupBy(*names).agg(F.sum("_n").alias("_n")).where("_n > 0")
    staged = scratch_path(spark, "merged")
    overwrite_parquet(left.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).select(*names), staged)
    merged = read_parquet(spark, staged, rows.schema).select(*names)
    if not partition_by:
        overwrite_parquet(merged, target_path)
        return counts
    writer = merged.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(target_path)
    for place in places.exceptAll(merged.select(*partition_by).distinct()).collect():
        _remove(spark, target_path, place.asDict())
    return counts


def _remove(spark: SparkSession, path: str, place: dict[str, object]) -> None:
    """Delete a directory that no row is left for: a dynamic overwrite leaves it as it is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    parts = [f"{name}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}" for name, value in place.items()]
    folder = jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *parts]))
    folder.getFileSystem(conf).delete(folder, True)
