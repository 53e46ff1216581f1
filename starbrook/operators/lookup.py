"""Attaching a looked-up value to every row of a large table.

Three cases, chosen by measured size and all exact: the lookup is small and is broadcast; or the
lookup is large and evenly spread and is joined by a shuffle; or some keys are hot, and those are
answered by a broadcast of just the hot keys while the rest is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 48
# A key is hot when it holds more than one part in MOST_HOT_KEYS of the rows, so there can be no
# more hot keys than that, and when it has enough rows to matter.
MOST_HOT_KEYS = 20_000
LEAST_HOT_ROWS = 100_000
SALTS = 1 << 16


def size_in_bytes(df: DataFrame) -> Column:
    """Aggregate for the size of ``df``: text lengths plus a fixed cost per row and field."""
    size = F.lit(8 * len(df.columns) + ROW_OVERHEAD).cast("bigint")
    for field in df.schema.fields:
        if field.dataType.simpleString() == "string":
            size = size + F.coalesce(F.octet_length(field.name), F.lit(0))
    return F.coalesce(F.sum(size), F.lit(0))


def measured_bytes(df: DataFrame) -> int:
    return df.agg(size_in_bytes(df).alias("bytes")).first()["bytes"]


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, limit) else df


def hot_keys(rows: DataFrame, key: str) -> DataFrame:
    """At most MOST_HOT_KEYS keys that hold many rows. Counts are combined before the shuffle."""
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = rows.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    limit = max(total // MOST_HOT_KEYS, LEAST_HOT_ROWS)
    return counts.filter(F.col("n") > limit).select(key)


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    values: list[str],
    small: bool | None = None,
) -> DataFrame:
    """Left join of ``rows`` with ``lookup`` (unique on ``key``), adding ``values``.

    ``small`` says whether the caller has already measured the lookup.
    """
    lookup = lookup.select(key, *values)
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        return rows.join(F.broadcast(lookup), key, "left")
    return _attach_large(rows, lookup, key, values)


def _attach_large(
    rows: DataFrame, lookup: DataFrame, key: str, values: list[str]
) -> DataFrame:
    hot = hot_keys(rows, key)
    # at most MOST_HOT_KEYS rows
    answers = lookup.join(F.broadcast(hot), key, "left_semi").select(
        key, F.struct(*values).alias("_hot")
    )
    # Rows answered already, and rows without a key, take no part in the match. They carry a null
    # join key and are spread by a salt from their content and from the task that read them:
    # content alone would keep identical copies together, and both are the same when a task is
    # repeated.
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *rows.columns), F.lit(SALTS))
    spread = (
        rows.join(F.broadcast(answers), key, "left")
        .withColumn("_key", F.when(F.col("_hot").isNull(), F.col(key)))
        .withColumn("_salt", F.when(F.col("_key").isNull(), salt).otherwise(F.lit(0)))
    )
    # Always 0, but not as a constant: the optimizer would take a constant out of the join key.
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    rest = lookup.select(
        F.col(key).alias("_key"), zero.alias("_salt"), F.struct(*values).alias("_cold")
    )
    joined = spread.join(rest, ["_key", "_salt"], "left")
    found = F.coalesce("_hot", "_cold")
    return joined.select(*rows.columns, *(found.getField(v).alias(v) for v in values))


def known_members(members: DataFrame, table: DataFrame, key: str, members_small: bool) -> DataFrame:
    """Rows of ``table`` whose key occurs in ``members``; both sides hold a key once, so no key is hot.

    Small member sets are broadcast, so the table is scanned in place instead of shuffled.
    """
    keys = members.select(key)
    return table.join(F.broadcast(keys) if members_small else keys, key, "left_semi")


def missing_members(
    members: DataFrame, known: DataFrame, key: str, members_small: bool
) -> DataFrame:
    """Members not among ``known``, which itself is no larger than ``members``."""
    keys = known.select(key)
    return members.join(F.broadcast(keys) if members_small else keys, key, "left_anti")


def batch_keys(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``dimension``, ``natural_id``, ``events``: how often the rows mention each member of any dimension.

    ``columns`` maps dimensions to the columns with their members. Mentions are counted before the
    shuffle, so a member that most rows mention arrives as one row a task; null mentions nobody.
    """
    pairs = F.array(
        *(
            F.struct(F.lit(d).alias("dimension"), F.col(c).cast("string").alias("natural_id"))
            for d, c in columns.items()
        )
    )
    mentioned = rows.select(F.inline(pairs)).filter(F.col("natural_id").isNotNull())
    return mentioned.groupBy("dimension", "natural_id").agg(F.count(F.lit(1)).alias("events"))


def resolve_keys(keys: DataFrame, tables: dict[str, DataFrame], keys_small: bool) -> DataFrame:
    """``dimension``, ``natural_id``, ``events``, ``surrogate_key`` of the ``batch_keys`` that are known.

    ``tables`` maps dimensions to (natural key, surrogate key) rows, in several versions maybe. All
    dimensions are one side of one join: the batch's keys are shuffled once, whatever the number of
    dimensions, and not again for the join. Small key sets are broadcast first, so that only members
    the batch mentions are shuffled.
    """
    known = None
    for name, table in tables.items():
        natural, key = table.columns
        part = table.select(
            F.lit(name).alias("dimension"),
            F.col(natural).cast("string").alias("natural_id"),
            F.col(key).alias("surrogate_key"),
        )
        known = part if known is None else known.unionByName(part)
    if keys_small:
        wanted = F.broadcast(keys.select("dimension", "natural_id"))
        known = known.join(wanted, ["dimension", "natural_id"], "left_semi")
    # the versions of a member have one key
    once = known.groupBy("dimension", "natural_id").agg(F.max("surrogate_key").alias("surrogate_key"))
    return keys.join(once, ["dimension", "natural_id"])
