"""Suppression of repeated messages before anything is looked up, by keyed streaming state.

State holds a digest of each message that arrived within a span, and nothing of its content. The
span is measured by arrival, not by event time, so no message is ever too late for it: a repeat that
comes after its digest has been forgotten passes, as does an event of any age, and meets the exact
comparison with the fact table. Suppression therefore only saves work.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DIGEST, ARRIVED = "_digest", "_arrived"


def message_digest(columns: list[str]) -> Column:
    """Equal for messages of equal key and value; null differs from empty."""
    parts = [F.coalesce(F.hex(c), F.lit("-")) for c in ("key", "value") if c in columns]
    return F.unhex(F.sha2(F.concat_ws("/", *parts), 256))


def without_repeats(messages: DataFrame, within: str) -> DataFrame:
    """The messages of a stream without those that arrived before, ``within`` (such as ``2 hours``).

    Messages are shuffled once, by digest; a message delivered very often is one key of the state, and
    its repeats go no further than the task that holds it.
    """
    keyed = messages.withColumn(DIGEST, message_digest(messages.columns)).withColumn(
        ARRIVED, F.current_timestamp()
    )
    first = keyed.withWatermark(ARRIVED, within).dropDuplicatesWithinWatermark([DIGEST])
    return first.select(*messages.columns)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streaming queries that are started inside keep their state on the executors' disks, where it does
    not take heap however many messages a span holds. A checkpoint stays with the store it began with."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ON_DISK)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)
