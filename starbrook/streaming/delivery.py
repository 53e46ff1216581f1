"""A durable log of what streaming queries delivered, micro-batch by micro-batch.

Query progress keeps a bounded number of batches and is gone with the driver. ``DeliveryLog`` listens
to progress and writes one row a micro-batch: rows read, rows and bytes observed on the way to the
sink, repeats cut by state, and offsets. The row of a batch has a folder of its own, named by query
and batch, so a batch that is repeated after a restart replaces its row and is counted once. Batch
numbers have no gaps, so a row that was lost with the driver shows as a missing batch.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from starbrook.schemas import LONG, TEXT, columns

OBSERVED = "delivery"
OFFSETS = "map<string,map<string,bigint>>"
DELIVERIES = columns(
    query=TEXT,
    batch=LONG,
    name=TEXT,
    read_rows=LONG,
    delivered_rows=LONG,
    delivered_bytes=LONG,
    repeats_cut=LONG,
    newest_offsets=TEXT,
    read_offsets=TEXT,
)


def observed(messages: DataFrame) -> DataFrame:
    """Counts messages and their bytes as they pass; the counts arrive with the batch's progress."""
    return messages.observe(
        OBSERVED, F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("value")).alias("bytes")
    )


class DeliveryLog(StreamingQueryListener):
    """``spark.streams.addListener(DeliveryLog(spark, path))``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        self._end(event.runId)

    def onQueryProgress(self, event) -> None:
        progress = json.loads(event.progress.json)
        if "addBatch" in progress.get("durationMs", {}):  # others ran no batch
            self.write(progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(event.runId).set()

    def _end(self, run) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(str(run), threading.Event())

    def write(self, progress: dict) -> None:
        """Writes the row of one batch; it is built in the JVM, without a Python worker."""
        seen = progress.get("observedMetrics", {}).get(OBSERVED) or {}
        cut = sum(
            int(state.get("customMetrics", {}).get("numDroppedDuplicateRows", 0))
            for state in progress.get("stateOperators", [])
        )
        newest, read = topic_offsets(progress, "latestOffset"), topic_offsets(progress, "endOffset")
        values = {
            "name": progress.get("name"),
            "read_rows": int(progress.get("numInputRows", 0)),
            "delivered_rows": seen.get("rows"),
            "delivered_bytes": seen.get("bytes"),
            "repeats_cut": cut,
            "newest_offsets": json.dumps(newest),
            "read_offsets": json.dumps(read),
        }
        row = self.spark.range(0, 1, 1, 1).select(
            *(F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in DELIVERIES.fields[2:])
        )
        row.write.mode("overwrite").parquet(
            f"{self.path}/query={progress['id']}/batch={progress['batchId']}"
        )

    def wait(self, query: StreamingQuery, seconds: float = 600) -> None:
        """Returns when all batches of a query that has ended are in the log."""
        if not self._end(query.runId).wait(seconds):
            raise TimeoutError(f"no end of {query.runId} within {seconds} seconds")


def topic_offsets(progress: dict, kind: str) -> dict[str, dict[str, int]]:
    """Offsets by topic and partition over all sources; file sources have none."""
    found: dict[str, dict[str, int]] = {}
    for source in progress.get("sources", []):
        offsets = source.get(kind)
        offsets = json.loads(offsets) if isinstance(offsets, str) and offsets else offsets
        for topic, parts in (offsets or {}).items() if isinstance(offsets, dict) else ():
            if isinstance(parts, dict):
                found.setdefault(topic, {}).update({p: int(n) for p, n in parts.items()})
    return found


def read_deliveries(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DELIVERIES).option("basePath", path).parquet(path)


def delivery_totals(deliveries: DataFrame) -> DataFrame:
    """One row a query: batches, rows, bytes and repeats over its whole life."""
    totals = deliveries.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"),
        (F.max("batch") + 1 - F.count(F.lit(1))).alias("missing_batches"),
        F.sum("read_rows").alias("read_rows"),
        F.sum("delivered_rows").alias("delivered_rows"),
        F.sum("delivered_bytes").alias("delivered_bytes"),
        F.sum("repeats_cut").alias("repeats_cut"),
    )
    return totals


def running_totals(deliveries: DataFrame) -> DataFrame:
    """Rows forwarded by each batch, and up to it. One row a batch, so a window by query is small."""
    upto = W.partitionBy("query").orderBy("batch")
    return deliveries.select(
        "query",
        "batch",
        F.col("read_rows").alias("forwarded"),
        F.sum("read_rows").over(upto).alias("total"),
    )


def offset_lag(deliveries: DataFrame) -> DataFrame:
    """``query``, ``batch``, ``topic``, ``behind``: messages between the newest offset a batch knew of and
    the last it read. A partition that was not read yet is behind by all its messages."""
    parsed = deliveries.select(
        "query",
        "batch",
        F.from_json("newest_offsets", OFFSETS).alias("newest"),
        F.from_json("read_offsets", OFFSETS).alias("read"),
    )
    parts = parsed.select("query", "batch", "read", F.explode("newest").alias("topic", "parts"))
    rows = parts.select("query", "batch", "topic", "read", F.explode("parts").alias("part", "newest"))
    done = F.coalesce(F.try_element_at(F.try_element_at("read", F.col("topic")), F.col("part")), F.lit(0))
    return (
        rows.withColumn("behind", F.col("newest") - done)
        .groupBy("query", "batch", "topic")
        .agg(F.sum("behind").alias("behind"))
    )
