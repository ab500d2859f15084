"""Loading a folder in which files arrive, as a stream that runs until it has read what is there."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class StreamResult:
    """Rows read from new files, and those too late to be told from rows that were loaded before."""

    read: int
    late: int


def stream_load(
    spark: SparkSession,
    candidates: Callable[[DataFrame], DataFrame],
    finish: Callable[[DataFrame], DataFrame],
    *,
    source_path: str,
    schema: T.StructType,
    ts: str,
    delay: str,
    target_path: str,
    checkpoint_path: str,
    partition_by: tuple[str, ...] = (),
) -> StreamResult:
    """Append the rows of new Parquet files under ``source_path`` to the target, and stop when there are no more.

    ``candidates`` makes raw rows with a parsed ``ts``; of equal ones the first is kept, also over runs, because Spark's
    checkpoint holds the rows of the last ``delay``. The watermark is the latest ``ts`` so far, less the delay. A row at or before the watermark of
    its batch is late: it may have been loaded before and forgotten, so it is dropped and counted; rows that really come that late are found by
    comparing the whole source with the target (``merge_snapshot``). Rows without a time are dropped, as by the load mark.

    Files are read once even if a run breaks off: the checkpoint names them, and the target's log names the files that count.
    Read the target by its path as a whole.
    """
    raw = spark.readStream.schema(schema).parquet(source_path)
    timed = candidates(raw)
    timed = timed.where(timed[ts].isNotNull()).withWatermark(ts, delay)
    rows = finish(timed.dropDuplicatesWithinWatermark(timed.columns))
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint_path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    running = writer.trigger(availableNow=True).start(target_path)
    running.awaitTermination()
    steps = running.recentProgress
    late = sum(state["numRowsDroppedByWatermark"] for step in steps for state in step["stateOperators"])
    return StreamResult(sum(step["numInputRows"] for step in steps), late)
