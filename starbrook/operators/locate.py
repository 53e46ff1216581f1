"""IP address to location: a point-in-range lookup without a nested loop.

Ranges are cut at the borders of address bins of 2^16, which adds at most one piece per bin
(65,536 in all) because ranges do not overlap. A bin holds at most 65,536 addresses and as many
pieces, whatever the data, so no bin can grow hot once addresses are distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starbrook.functions.geo import BIN_BITS, ip_bin, ip_to_long, location_id
from starbrook.operators.lookup import attach, fits_broadcast
from starbrook.schemas import LOCATION_SCHEMA

LOCATION_COLUMNS = LOCATION_SCHEMA.fieldNames()
# The range table saves a shuffle of every event, so it may be larger than other broadcasts.
RANGE_BROADCAST_BYTES = 256 * 1024 * 1024


def ranges_fit(ranges: DataFrame, limit: int = RANGE_BROADCAST_BYTES) -> bool:
    return fits_broadcast(range_pieces(ranges), limit)


def range_pieces(ranges: DataFrame) -> DataFrame:
    """One row per range and address bin it touches."""
    return ranges.select(
        "*", F.explode(F.sequence(ip_bin(F.col("ip_from")), ip_bin(F.col("ip_to")))).alias("bin")
    ).select(
        "bin",
        F.greatest("ip_from", F.shiftleft(F.col("bin").cast("bigint"), BIN_BITS)).alias("ip_from"),
        F.least("ip_to", F.shiftleft(F.col("bin").cast("bigint") + 1, BIN_BITS) - 1).alias("ip_to"),
        location_id(F.col("country_name"), F.col("region_name"), F.col("city_name")).alias(
            "location_id"
        ),
        *LOCATION_COLUMNS[1:],
    )


def overlapping_ranges(ranges: DataFrame) -> DataFrame:
    """Pieces that start before an earlier piece of their bin has ended; must be empty."""
    order = W.partitionBy("bin").orderBy("ip_from", "ip_to")
    before = F.max("ip_to").over(order.rowsBetween(W.unboundedPreceding, -1))
    return (
        range_pieces(ranges)
        .withColumn("taken_to", before)
        .filter(F.col("ip_from") <= F.col("taken_to"))
    )


def locate(
    rows: DataFrame, ranges: DataFrame, ip: str = "ip", ranges_small: bool | None = None
) -> DataFrame:
    """Adds the struct ``loc_info``, null where the address is invalid or in no range.

    ``ranges_small`` says whether the caller has already measured the ranges.
    """
    pieces = range_pieces(ranges)
    if ranges_small is None:
        ranges_small = ranges_fit(ranges)
    if ranges_small:
        return _locate_in_place(rows, pieces, ip)
    return attach(rows, _locate_distinct(rows, pieces, ip), ip, ["loc_info"], small=False)


def _locate_in_place(rows: DataFrame, pieces: DataFrame, ip: str) -> DataFrame:
    """The range table is broadcast by bin; the events are not moved at all."""
    addressed = rows.withColumn("_address", ip_to_long(F.col(ip)))
    side = pieces.select(
        "bin", "ip_from", "ip_to", F.struct(*LOCATION_COLUMNS).alias("loc_info")
    )
    inside = (
        (ip_bin(F.col("_address")) == F.col("bin"))
        & (F.col("_address") >= F.col("ip_from"))
        & (F.col("_address") <= F.col("ip_to"))
    )
    return addressed.join(F.broadcast(side), inside, "left").drop(
        "_address", "bin", "ip_from", "ip_to"
    )


def _locate_distinct(rows: DataFrame, pieces: DataFrame, ip: str) -> DataFrame:
    """Distinct addresses merged with the ranges of their bin in address order.

    The range of an address is the last one starting at or before it, so one ordered pass per
    bin answers all of them and no pair of address and range is ever formed.
    """
    addresses = (
        rows.select(ip)
        .distinct()
        .withColumn("address", ip_to_long(F.col(ip)))
        .filter(F.col("address").isNotNull())
    )
    location = F.struct("ip_to", *LOCATION_COLUMNS)
    merged = pieces.select(
        "bin",
        F.col("ip_from").alias("address"),
        F.lit(0).alias("is_address"),
        F.lit(None).cast("string").alias(ip),
        location.alias("piece"),
    ).unionByName(
        addresses.select(
            ip_bin(F.col("address")).alias("bin"),
            "address",
            F.lit(1).alias("is_address"),
            ip,
            F.lit(None).alias("piece"),
        )
    )
    order = W.partitionBy("bin").orderBy("address", "is_address")
    last = F.last("piece", ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        merged.withColumn("piece", last)
        .filter((F.col("is_address") == 1) & (F.col("address") <= F.col("piece.ip_to")))
        .select(ip, F.struct(*(F.col(f"piece.{c}") for c in LOCATION_COLUMNS)).alias("loc_info"))
    )
