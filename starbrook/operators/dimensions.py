"""Members of the six dimensions, and how a batch changes them.

``*_members`` reduce a prepared batch (see ``facts.prepare_events``) to one row per natural key.
All of them combine rows before any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbrook.functions import scalars as S
from starbrook.functions.useragent import browser_family, os_family
from starbrook.schemas import STAR_TABLES


def product_members(events: DataFrame) -> DataFrame:
    return events.select("product_id").filter(S.present(F.col("product_id"))).distinct()


def store_members(events: DataFrame) -> DataFrame:
    ids = events.select("store_id").filter(S.present(F.col("store_id"))).distinct()
    return ids.withColumn("store_name", S.store_name(F.col("store_id")))


def location_members(events: DataFrame) -> DataFrame:
    """Attributes outside the identity (short code, null or empty parts) take the smallest variant."""
    attributes = ["country_name", "country_short", "region_name", "city_name"]
    variants = (
        events.select("location_id", *attributes).filter(F.col("location_id").isNotNull()).distinct()
    )
    first = variants.groupBy("location_id").agg(F.min(F.struct(*attributes)).alias("a"))
    return first.select("location_id", *(F.col(f"a.{c}") for c in attributes))


def device_members(events: DataFrame) -> DataFrame:
    """Families are parsed once per distinct user agent and resolution."""
    variants = events.select("device_hash", "user_agent", "resolution").filter(
        F.col("device_hash").isNotNull()
    )
    raw = variants.distinct().groupBy("device_hash").agg(
        F.min(F.struct("user_agent", "resolution")).alias("v")
    )
    agent, resolution = F.col("v.user_agent"), F.col("v.resolution")
    return raw.select(
        F.col("device_hash").alias("device_id"),
        S.text_or_unknown(agent).alias("user_agent"),
        S.text_or_unknown(resolution).alias("resolution"),
        os_family(agent).alias("os"),
        browser_family(agent).alias("browser"),
    )


def customer_members(events: DataFrame) -> DataFrame:
    """Latest known e-mail and user id per customer, with the time each was seen.

    First the latest time per distinct combination, with fixed-size buffers that hash-aggregate
    before the shuffle; then the winner among the few combinations left. Equal times are decided
    by the greater text. An unknown label never wins over a known text.
    """
    combos = events.groupBy("customer_id", "email_address", "user_id_db").agg(
        F.max("event_millis").alias("seen_at")
    )

    def latest(name: str) -> Column:
        known = F.col(name) != S.UNKNOWN_TEXT
        seen = F.coalesce("seen_at", F.lit(S.FIRST_MILLI))
        return F.max(F.when(known, F.struct(seen.alias("at"), F.col(name).alias("text"))))

    best = combos.groupBy("customer_id").agg(
        latest("email_address").alias("e"), latest("user_id_db").alias("u")
    )
    unknown = F.lit(S.UNKNOWN_TEXT)
    return best.select(
        "customer_id",
        F.coalesce("e.text", unknown).alias("email_address"),
        F.coalesce("u.text", unknown).alias("user_id_db"),
        F.col("e.at").alias("email_seen_at"),
        F.col("u.at").alias("user_seen_at"),
    )


def overlay_customers(current: DataFrame, members: DataFrame, members_small: bool) -> DataFrame:
    """New versions of known customers, only where the batch changes something."""
    new = members.select(
        "customer_id", F.struct(*(c for c in members.columns if c != "customer_id")).alias("n")
    )
    old = current.select(
        "customer_id", "customer_key", F.struct(*members.columns[1:]).alias("o")
    )
    both = old.join(F.broadcast(new) if members_small else new, "customer_id")

    def newer(at: str, text: str) -> Column:
        """The later text wins, the greater on equal times; a side that knows none never does."""
        mine, theirs = F.col(f"o.{at}"), F.col(f"n.{at}")
        wins = mine.isNull() | (theirs > mine)
        tie = (theirs == mine) & (F.col(f"n.{text}") > F.col(f"o.{text}"))
        return theirs.isNotNull() & (wins | tie)

    email_wins = newer("email_seen_at", "email_address")
    user_wins = newer("user_seen_at", "user_id_db")

    def pick(wins: Column, name: str) -> Column:
        return F.when(wins, F.col(f"n.{name}")).otherwise(F.col(f"o.{name}")).alias(name)

    return both.filter(email_wins | user_wins).select(
        "customer_key",
        "customer_id",
        pick(email_wins, "email_address"),
        pick(user_wins, "user_id_db"),
        pick(email_wins, "email_seen_at"),
        pick(user_wins, "user_seen_at"),
    )


def date_members(events: DataFrame) -> DataFrame:
    days = events.filter(F.col("date_id").isNotNull()).select("date_id").distinct()
    return days.withColumn("day", S.date_of(F.col("date_id"))).select(
        *S.date_attributes(F.col("day"))
    )


@dataclass(frozen=True)
class Dimension:
    """A dimension with a surrogate key, and where a batch finds its natural key."""

    table: str
    natural: str
    key: str
    event_column: str
    members: Callable[[DataFrame], DataFrame]

    def conform(self, numbered: DataFrame) -> DataFrame:
        """Declared columns first; those no feed supplies are null."""
        declared = [
            F.col(f.name) if f.name in numbered.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in STAR_TABLES[self.table].fields
        ]
        extra = [c for c in numbered.columns if c not in STAR_TABLES[self.table].fieldNames()]
        return numbered.select(*declared, *extra)


DIMENSIONS = [
    Dimension("dim_product", "product_id", "product_key", "product_id", product_members),
    Dimension("dim_store", "store_id", "store_key", "store_id", store_members),
    Dimension("dim_location", "location_id", "location_key", "location_id", location_members),
    Dimension("dim_customer", "customer_id", "customer_key", "customer_id", customer_members),
    Dimension("dim_device", "device_id", "device_key", "device_hash", device_members),
]
