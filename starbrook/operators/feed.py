"""Throughput and lag of the feed, per tumbling window; the same code serves batch and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starbrook.operators.lookup import broadcast_if_small

WINDOW = "1 hour"
LAG_LIMIT_MILLIS = 60_000


def throughput(events: DataFrame, time: str, window: str = WINDOW, by: str | None = None) -> DataFrame:
    """Events per window; hash-aggregated on fixed-size buffers before the shuffle."""
    keys = [F.window(time, window)] + ([F.col(by)] if by else [])
    counted = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))
    return counted.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *([by] if by else []),
        "events",
    )


def lag(
    events: DataFrame,
    time: str,
    arrival: str,
    window: str = WINDOW,
    limit_millis: int = LAG_LIMIT_MILLIS,
) -> DataFrame:
    """Arrival behind event time per window, from sums that merge exactly in any order."""
    behind: Column = F.unix_millis(arrival) - F.unix_millis(time)
    measured = (
        events.withColumn("_behind", behind)
        .groupBy(F.window(time, window))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("_behind").alias("total_lag_ms"),
            F.max("_behind").alias("max_lag_ms"),
            F.count(F.when(F.col("_behind") > limit_millis, 1)).alias("late_events"),
        )
    )
    windows = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    sums = ["events", "total_lag_ms", "max_lag_ms", "late_events"]
    return with_status(measured.select(*windows, *sums), limit_millis)


def with_status(measured: DataFrame, limit_millis: int) -> DataFrame:
    behind = F.when(F.col("max_lag_ms") > limit_millis, "behind").otherwise("healthy")
    return measured.withColumn("lag_status", behind)


def lag_percentiles(events: DataFrame, time: str, arrival: str, window: str = WINDOW) -> DataFrame:
    """Median, 95th and 99th percentile of the lag per window, as values that occur."""
    behind = F.unix_millis(arrival) - F.unix_millis(time)
    # equal lags are counted together before the shuffle, so a window's buffer holds distinct lags
    counted = events.groupBy(F.window(time, window).alias("window"), behind.alias("lag")).count()
    so_far = W.partitionBy("window").orderBy("lag").rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = counted.filter("lag is not null").select(
        "window",
        "lag",
        F.sum("count").over(so_far).alias("upto"),
        F.sum("count").over(W.partitionBy("window")).alias("events"),
    )

    def at(share: float):
        return F.min(F.when(F.col("upto") >= F.ceil(F.col("events") * F.lit(share)), F.col("lag")))

    return placed.groupBy("window").agg(
        at(0.5).alias("p50_ms"), at(0.95).alias("p95_ms"), at(0.99).alias("p99_ms")
    ).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "p50_ms",
        "p95_ms",
        "p99_ms",
    )


# The rank of a quantile read from a sketch of SKETCH_SIZE is wrong by more than this part of a window's
# events with a probability far below one in a hundred (2.3 / 1000^0.97 is 0.0028 at 99 percent).
SKETCH_SIZE = 1000
RANK_ERROR = 0.01
SHARES = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}


def lag_sketches(
    events: DataFrame, time: str, arrival: str, window: str = WINDOW, size: int = SKETCH_SIZE
) -> DataFrame:
    """A quantile sketch of the lag per window. Sketches are begun in the tasks, before the shuffle, and
    merge in any order, so a window of any size takes a buffer of a few kilobytes and no task of its own."""
    behind = F.unix_millis(arrival) - F.unix_millis(time)
    sketched = (
        events.withColumn("_behind", behind)
        .filter(F.col("_behind").isNotNull())
        .groupBy(F.window(time, window))
        .agg(F.count(F.lit(1)).alias("events"), F.kll_sketch_agg_bigint("_behind", F.lit(size)).alias("sketch"))
    )
    return sketched.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "events", "sketch"
    )


def merged_percentiles(sketches: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Percentiles of each window over all its sketches, to within ``RANK_ERROR`` in rank."""
    merged = sketches.groupBy("window_start", "window_end").agg(
        F.sum("events").alias("events"), F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("sketch")
    )
    values = F.kll_sketch_get_quantile_bigint("sketch", F.array(*map(F.lit, SHARES.values())))
    return merged.withColumn("v", values).select(
        "window_start", "window_end", "events", *(F.col("v")[i].alias(n) for i, n in enumerate(SHARES))
    )


def rank_errors(events: DataFrame, time: str, arrival: str, found: DataFrame, window: str = WINDOW) -> DataFrame:
    """How far, in parts of the window's events, each percentile in ``found`` is from its rank: 0 where
    its share lies between the parts of events below it and up to it."""
    rows = events.select(
        F.window(time, window).alias("w"), (F.unix_millis(arrival) - F.unix_millis(time)).alias("lag")
    ).filter("lag is not null")
    # a row a window; the events stay in place as long as that fits a broadcast
    met = rows.withColumn("window_start", F.col("w.start")).join(
        broadcast_if_small(found.drop("events", "window_end")), "window_start"
    )
    counts = met.groupBy("window_start").agg(
        F.count(F.lit(1)).alias("n"),
        *(F.count_if(F.col("lag") < F.col(c)).alias(f"below_{c}") for c in SHARES),
        *(F.count_if(F.col("lag") <= F.col(c)).alias(f"upto_{c}") for c in SHARES),
    )
    zero = F.lit(0.0)
    return counts.select(
        "window_start",
        *(
            F.greatest(zero, F.col(f"below_{c}") / F.col("n") - share, share - F.col(f"upto_{c}") / F.col("n")).alias(c)
            for c, share in SHARES.items()
        ),
    )
