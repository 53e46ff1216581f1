"""The ids of all facts as a bucketed table, so that a batch meets any history by moving only itself.

Ids are stored by day and, within a day, in buckets of their hash. A batch is shuffled into as many
parts and compared bucket by bucket; the history is read in place, and only its touched days. Rows
carry the attempt that wrote them and are seen as its batch is, so a batch that never succeeded
leaves nothing behind that counts.

The table is external: its files are the record, and a session whose catalog does not know it (or
not all of its days) finds them when the ledger is opened. The number of buckets is part of the
files and must stay as it was; choose it for the largest batch, not for the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.sources import files

BUCKETS = 64
_COLUMNS = ["fact_id", "batch_id", "date_id"]  # the partition column comes last


class FactLedger:
    """``name`` is the table's name in the session's catalog, ``path`` its folder."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int = BUCKETS):
        self.spark, self.name, self.path, self.buckets = spark, name, path.rstrip("/"), buckets
        existing = files.exists(spark, self.path)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (fact_id STRING, batch_id BIGINT, date_id INT) USING parquet "
            f"PARTITIONED BY (date_id) CLUSTERED BY (fact_id) SORTED BY (fact_id) INTO {int(buckets)} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        if existing:
            spark.catalog.recoverPartitions(name)

    def rows(self, days: list[int | None] | None = None) -> DataFrame:
        """All ids, or those of the days named; None among them stands for ids without a day."""
        ids = self.spark.table(self.name)
        if days is None:
            return ids
        dated = F.col("date_id").isin([d for d in days if d is not None])
        return ids.filter(dated | F.col("date_id").isNull() if None in days else dated)

    def append(self, ids: DataFrame, attempt: int) -> None:
        """Adds ``fact_id``, ``date_id`` rows of one attempt: at most one file per bucket and day."""
        rows = ids.select("fact_id", F.lit(attempt).cast("bigint").alias("batch_id"), "date_id")
        rows.repartition(self.buckets, "fact_id").select(*_COLUMNS).write.insertInto(self.name)

    def absent(self, facts: DataFrame, shown: Column, days: list[int | None] | None = None) -> DataFrame:
        """Facts whose id no batch that ``shown`` admits has written, in the days given."""
        taken = self.rows(days).filter(shown).select("fact_id")
        # merged by bucket: a hint for any other join would move or copy the history
        return facts.join(taken.hint("merge"), "fact_id", "left_anti")
