"""Report queries over the star schema.

Every report counts fact rows by surrogate key first and joins the dimension to the counts, so
the join input is one row per key, not one per view, and a hot key is combined before any shuffle.
The day is compared with the partition column.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starbrook.functions import scalars as S
from starbrook.operators.numbering import number_rows

TOP_PRODUCTS = TOP_COUNTRIES = 10
TOP_REFERRERS = 5
RECENT_PRODUCTS = 100

VIEWS = "view_count"


def day_id(day: date | int) -> int:
    return day if isinstance(day, int) else day.year * 10000 + day.month * 100 + day.day


def on_day(fact: DataFrame, day: date | int) -> DataFrame:
    return fact.filter(F.col("date_id") == day_id(day))


def latest_report_date(fact: DataFrame, today: date | Column | None = None) -> DataFrame:
    """The newest day with a fact, else ``today``; reads only the partition column."""
    newest = F.max(S.date_of(F.col("date_id")))
    return fact.agg((F.coalesce(newest, F.lit(today)) if today is not None else newest).alias("max_date"))


def views_by(fact: DataFrame, *keys: str) -> DataFrame:
    """Views per surrogate key; rows without the key cannot match and are left out."""
    matched = fact.dropna(subset=list(keys))
    return matched.groupBy(*keys).agg(F.count(F.lit(1)).alias(VIEWS))


def _sum_by(counts: DataFrame, *names: str) -> DataFrame:
    return counts.groupBy(*names).agg(F.sum(VIEWS).alias(VIEWS))


def _top(counts: DataFrame, name: str, n: int) -> DataFrame:
    """The n largest, equal counts by name, ranked; ranking sees at most n rows."""
    order = [F.col(VIEWS).desc(), F.col(name).asc_nulls_first()]
    return (
        counts.orderBy(*order)
        .limit(n)
        .select(F.row_number().over(W.orderBy(*order)).cast("bigint").alias("rank"), name, VIEWS)
    )


def top_products(
    fact: DataFrame, dim_product: DataFrame, day: date | int, n: int = TOP_PRODUCTS
) -> DataFrame:
    counts = views_by(on_day(fact, day), "product_key")
    named = counts.join(dim_product.select("product_key", "product_id"), "product_key")
    return _top(named.select("product_id", VIEWS), "product_id", n)


def top_countries(
    fact: DataFrame, dim_location: DataFrame, day: date | int, n: int = TOP_COUNTRIES
) -> DataFrame:
    counts = views_by(on_day(fact, day), "location_key")
    named = counts.join(dim_location.select("location_key", "country_name"), "location_key")
    return _top(_sum_by(named, "country_name"), "country_name", n)


def top_referrers(fact: DataFrame, day: date | int, n: int = TOP_REFERRERS) -> DataFrame:
    """A missing referrer is a group of its own."""
    counts = on_day(fact, day).groupBy("referrer_url").agg(F.count(F.lit(1)).alias(VIEWS))
    return _top(counts, "referrer_url", n)


def country_store_views(
    fact: DataFrame, dim_location: DataFrame, dim_store: DataFrame, country: str, day: date | int
) -> DataFrame:
    """All stores seen from one country, ranked; there may be many, so ranks are distributed."""
    places = dim_location.filter(F.col("country_name") == F.lit(country)).select("location_key")
    counts = views_by(on_day(fact, day), "location_key", "store_key")
    local = _sum_by(counts.join(places, "location_key"), "store_key")
    named = local.join(dim_store.select("store_key", "store_id"), "store_key")
    order = [F.col(VIEWS).desc(), F.col("store_id").asc()]
    return number_rows(named.select("store_id", VIEWS), order, "rank").select(
        "rank", "store_id", VIEWS
    )


def country_list(dim_location: DataFrame) -> DataFrame:
    names = dim_location.filter(F.col("country_name").isNotNull()).select("country_name")
    return names.distinct().orderBy("country_name")


def recent_products(
    fact: DataFrame, dim_product: DataFrame, day: date | int, n: int = RECENT_PRODUCTS
) -> DataFrame:
    keys = on_day(fact, day).select("product_key").dropna().distinct()
    named = keys.join(dim_product.select("product_key", "product_id"), "product_key")
    return named.select("product_id").orderBy("product_id").limit(n)


def product_hourly_views(
    fact: DataFrame, dim_product: DataFrame, product_id: str, day: date | int
) -> DataFrame:
    # product ids are unique in their dimension, so this is one row at most
    wanted = dim_product.filter(F.col("product_id") == F.lit(product_id)).select("product_key")
    views = on_day(fact, day).join(F.broadcast(wanted), "product_key")
    counts = views.groupBy(F.hour("time_stamp").alias("hour")).agg(F.count(F.lit(1)).alias(VIEWS))
    return counts.orderBy("hour")


def product_total_views(hourly: DataFrame) -> DataFrame:
    return hourly.agg(F.coalesce(F.sum(VIEWS), F.lit(0)).alias("total_views"))


def _device_counts(fact: DataFrame, dim_device: DataFrame, day: date | int) -> DataFrame:
    counts = views_by(on_day(fact, day), "device_key")
    return counts.join(dim_device.select("device_key", "browser", "os"), "device_key")


def browser_os_views(fact: DataFrame, dim_device: DataFrame, day: date | int) -> DataFrame:
    """Ranked pairs; there are at most as many as browser labels times system labels."""
    counts = _sum_by(_device_counts(fact, dim_device, day), "browser", "os")
    order = [F.col(VIEWS).desc(), F.col("browser"), F.col("os")]
    rank = F.row_number().over(W.orderBy(*order)).cast("bigint").alias("rank")
    return counts.select(rank, "browser", "os", VIEWS)


def browser_os_totals(fact: DataFrame, dim_device: DataFrame, day: date | int) -> DataFrame:
    """Pairs, browser totals and system totals from one aggregation."""
    pairs = _sum_by(_device_counts(fact, dim_device, day), "browser", "os")
    sets = pairs.groupingSets(
        [["browser", "os"], ["browser"], ["os"]], "browser", "os"
    ).agg(F.sum(VIEWS).alias(VIEWS), F.grouping_id().alias("g"))
    level = F.when(F.col("g") == 0, "browser_os").when(F.col("g") == 1, "browser").otherwise("os")
    return sets.select(level.alias("level"), "browser", "os", VIEWS)
