"""From parsed events to rows of the fact table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbrook.functions import scalars as S
from starbrook.operators.dimensions import DIMENSIONS
from starbrook.operators.locate import LOCATION_COLUMNS, locate
from starbrook.operators.lookup import attach

FACT_KEYS = ["product_key", "store_key", "location_key", "customer_key", "device_key", "date_id"]
_DESCRIPTION = ["id", "ip", "collection", "current_url", "referrer_url"]
# More touched days than this are checked by their overall span instead of one by one.
MAX_DAY_PREDICATES = 400


def prepare_events(
    events: DataFrame, ranges: DataFrame, ranges_small: bool | None = None
) -> DataFrame:
    """Normalised, located events: everything the dimensions and the fact need, and no more."""
    located = locate(events, ranges, ranges_small=ranges_small)
    agent, resolution = F.col("user_agent"), F.col("resolution")
    when = S.event_time(F.col("time_stamp"))
    extra = [c for c in ("reject_reason", "raw_value") if c in events.columns]
    return located.select(
        *_DESCRIPTION,
        "product_id",
        "store_id",
        S.customer_id(F.col("device_id")).alias("customer_id"),
        S.text_or_unknown(F.col("email_address")).alias("email_address"),
        S.text_or_unknown(F.col("user_id_db")).alias("user_id_db"),
        "user_agent",
        "resolution",
        F.when(S.has_device(agent, resolution), S.device_id(agent, resolution)).alias(
            "device_hash"
        ),
        *(F.col(f"loc_info.{c}").alias(c) for c in LOCATION_COLUMNS),
        "time_stamp",
        S.epoch_millis(F.col("time_stamp")).alias("event_millis"),
        when.alias("event_time"),
        S.date_id(when).alias("date_id"),
        *extra,
    )


def build_facts(prepared: DataFrame, lookups: dict[str, tuple[DataFrame, bool | None]]) -> DataFrame:
    """Attaches surrogate keys, derives the fact id and keeps one row per id.

    ``lookups`` maps a dimension table to its (natural key, surrogate key) rows and, if known,
    whether they are small. Columns no longer needed are dropped join by join.
    """
    rows = prepared.select(
        *_DESCRIPTION,
        *(d.event_column for d in DIMENSIONS),
        "time_stamp",
        "event_time",
        "date_id",
    )
    for dim in DIMENSIONS:
        lookup, small = lookups[dim.table]
        keys = lookup.select(F.col(dim.natural).alias(dim.event_column), dim.key)
        rows = attach(rows, keys, dim.event_column, [dim.key], small).drop(dim.event_column)
    return unique_facts(
        rows.withColumn("fact_id", S.fact_id([F.col(k) for k in FACT_KEYS], F.col("time_stamp")))
    )


def unique_facts(rows: DataFrame) -> DataFrame:
    """One row per fact id, the smallest by event id; copies are combined before the shuffle.

    Rows are left dealt by fact id alone, so that a comparison of ids need not move them again.
    """
    # the keys and the time are equal for equal ids
    kept = rows.groupBy("fact_id").agg(F.min(F.struct(*_DESCRIPTION, *FACT_KEYS, "event_time")).alias("d"))
    return kept.select(
        "fact_id",
        *(F.col(f"d.{key}") for key in FACT_KEYS),
        F.col("d.ip").alias("ip_address"),
        F.col("d.event_time").alias("time_stamp"),
        F.col("d.collection"),
        F.col("d.current_url"),
        F.col("d.referrer_url"),
    )


def touched_days(facts: DataFrame) -> tuple[list[int | None] | None, Column]:
    """Where rows equal to ``facts`` could already be: days (None for all) and a predicate.

    Equal fact ids have equal timestamps, so only each day's time span needs to be read. The
    predicate is made of literals, so days are pruned and row groups skipped by their statistics.
    """
    millis = F.unix_millis("time_stamp")
    spans = facts.groupBy("date_id").agg(F.min(millis).alias("t0"), F.max(millis).alias("t1"))

    def within(span) -> Column:
        first, last = (F.timestamp_millis(F.lit(span[t])) for t in ("t0", "t1"))
        return F.col("time_stamp").between(first, last)

    rows = spans.limit(MAX_DAY_PREDICATES + 1).collect()
    if len(rows) > MAX_DAY_PREDICATES:
        span = spans.agg(
            F.min("date_id").alias("d0"),
            F.max("date_id").alias("d1"),
            F.min("t0").alias("t0"),
            F.max("t1").alias("t1"),
        ).first()
        days = F.col("date_id").between(span["d0"], span["d1"]) & within(span)
        return None, F.col("date_id").isNull() | days
    touched = [
        F.col("date_id").isNull()
        if row["date_id"] is None
        else (F.col("date_id") == row["date_id"]) & within(row)
        for row in rows
    ]
    return [row["date_id"] for row in rows], reduce(lambda a, b: a | b, touched, F.lit(False))


def absent_facts(facts: DataFrame, existing: DataFrame, facts_small: bool) -> DataFrame:
    """Insert-if-absent: facts whose id is not in ``existing``.

    For a small batch the existing ids are first cut down to those that collide, by a broadcast
    of the batch's ids, so a day of history is scanned but not shuffled.
    """
    ids = facts.select("fact_id")
    taken = existing.select("fact_id")
    if facts_small:
        taken = F.broadcast(taken.join(F.broadcast(ids), "fact_id", "left_semi"))
    return facts.join(taken, "fact_id", "left_anti")
