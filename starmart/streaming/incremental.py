"""Append the rows after the mark, then move the mark."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.operators.aggregates import latest
from starmart.operators.cleaning import drop_exact_copies
from starmart.session import scratch_path
from starmart.sources.readers import read_parquet
from starmart.sources.writers import (
    append_parquet,
    append_partitioned,
    create_if_missing,
    observed,
    overwrite_parquet,
)
from starmart.streaming.marks import after_mark, get_mark, set_mark, wall_clock


@dataclass(frozen=True)
class LoadResult:
    rows: int
    mark: datetime


def has_rows(df: DataFrame) -> bool:
    """Spark stops at the first row it finds."""
    return not df.isEmpty()


def loaded_after(
    target: DataFrame, ts: str, since: datetime, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Target rows after a time. Directories by (year, month) and file statistics skip all older data."""
    rows = after_mark(target, ts, since)
    if partition_by[:2] == ("year", "month"):
        first = since - timedelta(days=1)
        rows = rows.filter(F.col("year") * 12 + F.col("month") >= first.year * 12 + first.month)
    return rows


def without_loaded(
    rows: DataFrame, loaded: DataFrame, key: str | tuple[str, ...], ts: str, mark: datetime
) -> DataFrame:
    """Leave out rows that an interrupted run or the lookback window has loaded before.

    After the mark these are equal rows, as a key may rightly occur twice in one
    load. Up to the mark it is every row whose key is known.
    """
    keys = (key,) if isinstance(key, str) else key
    new, old = rows.alias("new"), loaded.select(*rows.columns).alias("old")
    same = [F.col(f"new.{k}") == F.col(f"old.{k}") for k in keys]
    equal = reduce(and_, [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in rows.columns])
    late = F.col(f"new.{ts}") <= F.lit(mark.isoformat(sep=" ")).cast("timestamp")
    return new.join(old, reduce(and_, same) & (late | equal), "left_anti")


def load_increment(
    spark: SparkSession,
    candidates: DataFrame,
    finish: Callable[[DataFrame], DataFrame],
    *,
    table: str,
    key: str | tuple[str, ...],
    ts: str,
    control_path: str,
    target_path: str,
    partition_by: tuple[str, ...] = (),
    lookback: timedelta = timedelta(0),
) -> LoadResult:
    """Load what is newer than the mark of ``table``.

    ``candidates`` are raw rows with a parsed ``ts`` beside their text, of which exact copies are dropped
    here; ``finish`` makes them rows of the target. ``key`` is what identifies a row of the target.
    No rows are written when none are new. The data is written before the mark, and a
    second run after a crash in between adds no row twice. The new mark is the
    latest ``ts`` of the batch, also over rows that ``finish`` drops, and it never moves back.
    ``lookback`` reads again from before the mark, for rows that arrive late. Month directories help to find
    what is loaded if ``partition_by`` begins with year and month.
    """
    mark = get_mark(spark, control_path, table)
    since = mark - lookback if lookback else mark
    batch = after_mark(candidates, ts, since)
    shape = finish(batch)
    create_if_missing(shape, target_path, *partition_by)
    target = read_parquet(spark, target_path, shape.schema)
    if not has_rows(batch):
        ahead = loaded_after(target, ts, mark, partition_by)
        reached = latest(ahead, ts, "newest").select(wall_clock(F.col("newest"))).first()[0]
        if reached:
            set_mark(spark, control_path, table, reached)
        return LoadResult(0, reached or mark)

    seen, seen_metrics = observed(
        drop_exact_copies(batch), f"{table}_batch", wall_clock(F.max(ts)).alias("newest")
    )
    rows = finish(seen)
    loaded = loaded_after(target, ts, since, partition_by)
    again = has_rows(loaded)
    if again:
        # The target is read and written, and often no row is left: so the few rows take a step between.
        path = scratch_path(spark, f"{table}_rows")
        overwrite_parquet(without_loaded(rows, loaded, key, ts, mark), path)
        rows = read_parquet(spark, path, shape.schema)
        count = rows.count()  # from the footers of the files
    result, result_metrics = observed(rows, f"{table}_rows")
    if not again or count:
        if partition_by:
            append_partitioned(result, target_path, *partition_by)
        else:
            append_parquet(result, target_path)

    reached = max(mark, seen_metrics.get["newest"])
    set_mark(spark, control_path, table, reached)
    return LoadResult(count if again else result_metrics.get["rows"], reached)
