"""Reference data of the geolocation lookup: inclusive, non-overlapping IPv4 ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starbrook.operators.locate import overlapping_ranges
from starbrook.schemas import IP_RANGE_SCHEMA


def read_ip_ranges(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Parquet or CSV. Pin one version per run: new ranges change location ids of old addresses.

    Raises ValueError if ranges overlap, since an address then has no one answer.
    """
    ranges = spark.read.format(fmt).schema(IP_RANGE_SCHEMA).options(**options).load(path)
    clash = overlapping_ranges(ranges).first()
    if clash is not None:
        raise ValueError(f"ranges overlap from {clash['ip_from']} on, in {path}")
    return ranges
