"""Consecutive numbers over a total order, without sorting in a single task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starbrook.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def number_rows(
    df: DataFrame,
    order: list[Column],
    name: str,
    start: int = 0,
    freeze: Callable[[DataFrame], DataFrame] = cut_lineage,
) -> DataFrame:
    """Adds ``name`` = start + 1, start + 2, ... following ``order`` (must be a total order).

    Rows are range-partitioned and sorted, then frozen together with their place, because range
    bounds are sampled and a recomputed partition must not renumber rows. Only one row count per
    partition meets in a single task.
    """
    placed = freeze(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")
    )
    within = F.col("_place") - F.shiftleft(part, _ROW_BITS)
    return (
        placed.withColumn("_part", part)
        # one row per range partition, so its size is bounded by the partition count
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + within + F.lit(start + 1).cast("bigint"))
        .drop("_part", "_place", "_before")
    )
