"""Feed monitors as streaming queries.

Every micro-batch appends its own counts by window, and readers add them up. Nothing is held in
state and nothing is dropped: an event counts in its window however late it comes, and the newest
windows are there as far as they have been read. A repeated micro-batch overwrites its own counts;
a new checkpoint is a new feed beside the old one.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starbrook.operators import feed


def start_throughput(
    events: DataFrame,
    time: str,
    path: str,
    checkpoint: str,
    window: str = feed.WINDOW,
    trigger: dict | None = None,
) -> StreamingQuery:
    return _append(events, lambda batch: feed.throughput(batch, time, window), path, checkpoint, trigger)


def read_throughput(spark: SparkSession, path: str) -> DataFrame:
    """Events per window over all micro-batches so far."""
    parts = spark.read.parquet(path).groupBy("window_start", "window_end")
    return parts.agg(F.sum("events").alias("events"))


def start_lag(
    events: DataFrame,
    time: str,
    arrival: str,
    path: str,
    checkpoint: str,
    window: str = feed.WINDOW,
    limit_millis: int = feed.LAG_LIMIT_MILLIS,
    trigger: dict | None = None,
) -> StreamingQuery:
    def measure(batch: DataFrame) -> DataFrame:
        return feed.lag(batch, time, arrival, window, limit_millis)

    return _append(events, measure, path, checkpoint, trigger)


def read_lag(spark: SparkSession, path: str, limit_millis: int = feed.LAG_LIMIT_MILLIS) -> DataFrame:
    """Lag per window over all micro-batches so far."""
    parts = spark.read.parquet(path).groupBy("window_start", "window_end")
    return feed.with_status(
        parts.agg(
            F.sum("events").alias("events"),
            F.sum("total_lag_ms").alias("total_lag_ms"),
            F.max("max_lag_ms").alias("max_lag_ms"),
            F.sum("late_events").alias("late_events"),
        ),
        limit_millis,
    )


def start_lag_sketches(
    events: DataFrame,
    time: str,
    arrival: str,
    path: str,
    checkpoint: str,
    window: str = feed.WINDOW,
    size: int = feed.SKETCH_SIZE,
    trigger: dict | None = None,
) -> StreamingQuery:
    def measure(batch: DataFrame) -> DataFrame:
        return feed.lag_sketches(batch, time, arrival, window, size)

    return _append(events, measure, path, checkpoint, trigger)


def read_lag_percentiles(spark: SparkSession, path: str, size: int = feed.SKETCH_SIZE) -> DataFrame:
    """Percentiles of the lag per window over all micro-batches so far."""
    return feed.merged_percentiles(spark.read.parquet(path), size)


def feed_of(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the query that a checkpoint belongs to; known before its first batch."""
    metadata = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()
    return json.loads(metadata["value"])["id"]


def _append(
    events: DataFrame,
    measure: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    known: list[str] = []

    def process(batch: DataFrame, batch_id: int) -> None:
        if not known:
            known.append(feed_of(batch.sparkSession, checkpoint))
        # one row a window that the micro-batch touches
        counts = measure(batch).coalesce(1)
        counts.write.mode("overwrite").parquet(f"{path}/feed={known[0]}/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 minute"}))
        .start()
    )
