"""Retention, archive, footprint and compaction of warehouse tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.functions import scalars as S
from starbrook.operators.facts import absent_facts, touched_days
from starbrook.operators.lookup import fits_broadcast
from starbrook.schemas import INSTANT, LONG, STAR_TABLES, TEXT, columns
from starbrook.sources import files
from starbrook.sources.warehouse import BATCH, FACT, Warehouse, day_folder, newest_versions

RETENTION_DAYS = 30
ARCHIVE = "archive"
FOOTPRINT = "footprints"


def cutoff(as_of: Column, days: int = RETENTION_DAYS) -> Column:
    return as_of - F.make_interval(days=F.lit(days))


def archival_candidates(fact: DataFrame, as_of: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """Total and expired rows, in one pass."""
    old = F.count(F.when(F.col("time_stamp") < cutoff(as_of, days), 1))
    return fact.agg(
        F.count(F.lit(1)).alias("total_records"), old.alias("archival_candidates")
    ).select(
        "*",
        F.lit(days).alias("retention_days"),
        (F.col("archival_candidates") > 0).alias("has_candidates"),
    )


def split_by_age(fact: DataFrame, as_of: Column, days: int = RETENTION_DAYS):
    """(expired, kept). Rows without a time are never expired."""
    old = F.coalesce(F.col("time_stamp") < cutoff(as_of, days), F.lit(False))
    return fact.filter(old), fact.filter(~old)


def archive_path(warehouse: Warehouse) -> str:
    return f"{warehouse.root}/{ARCHIVE}/{FACT}"


def read_archive(warehouse: Warehouse, days: list[int | None] | None = None) -> DataFrame:
    spark, path = warehouse.spark, archive_path(warehouse)
    schema = warehouse.schema(FACT)
    present = files.folders(spark, path)
    names = present if days is None else [d for d in map(day_folder, days) if d in present]
    if not names:
        return spark.createDataFrame([], schema)
    paths = [f"{path}/{name}" for name in names]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def not_archived(warehouse: Warehouse, facts: DataFrame) -> DataFrame:
    days, spans = touched_days(facts)
    archived = read_archive(warehouse, days).filter(spans)
    return absent_facts(facts, archived, fits_broadcast(facts.select("fact_id")))


def append_archive(warehouse: Warehouse, facts: DataFrame) -> None:
    """Adds facts the archive does not hold yet, so that it can be repeated after a failure."""
    (
        not_archived(warehouse, facts.select(*warehouse.schema(FACT).fieldNames()))
        .hint("rebalance", "date_id")
        .write.mode("append")
        .partitionBy("date_id")
        .parquet(archive_path(warehouse))
    )


def archive_old_facts(warehouse: Warehouse, as_of: Column, days: int = RETENTION_DAYS) -> int:
    """Moves expired facts to the archive and returns how many there were; run between batches.

    The copy is verified before anything is removed. Whole days are dropped as folders; only the
    boundary day is rewritten. Every step can be repeated if the run is interrupted.
    """
    warehouse.complete_rewrites()
    spark = warehouse.spark
    limit = spark.range(1).select(cutoff(as_of, days).alias("at")).select(
        F.unix_micros("at").alias("micros"), S.date_id(F.col("at")).alias("day")
    ).first()
    at = F.timestamp_micros(F.lit(limit["micros"]))
    expired_days = [day for day in warehouse.days() if day <= limit["day"]]
    snapshot = warehouse.snapshot()
    expired = warehouse.rows(FACT, snapshot, expired_days).filter(F.col("time_stamp") < at)
    count = expired.count()
    if count == 0:
        return 0
    append_archive(warehouse, expired)
    left = not_archived(warehouse, expired).count()
    if left:
        raise RuntimeError(f"{left} of {count} expired facts are missing from the archive")
    for day in expired_days:
        if day < limit["day"]:
            files.delete(spark, f"{warehouse.path(FACT)}/{day_folder(day)}")
    if limit["day"] in expired_days:
        kept = warehouse.rows(FACT, snapshot, [limit["day"]]).filter(F.col("time_stamp") >= at)
        _rewrite_days(warehouse, [limit["day"]], kept)
    return count


def compact_fact_days(warehouse: Warehouse, days: list[int]) -> None:
    """Joins the batches of each given day into one folder, labelled with the newest of them.

    Run between batches: the label keeps the rows ahead of any batch that may still be repeated.
    All days are rewritten by one job.
    """
    warehouse.complete_rewrites()
    rows = warehouse.rows(FACT, warehouse.snapshot(), days)
    newest = rows.groupBy("date_id").agg(F.max(BATCH).alias("newest"))
    # one row per day
    labelled = rows.join(F.broadcast(newest), "date_id").withColumn(BATCH, F.col("newest"))
    _rewrite_days(warehouse, days, labelled.drop("newest"))


def compact_dimension(warehouse: Warehouse, table: str) -> None:
    """Rewrites a dimension as its current view, sorted by natural key, in one batch folder."""
    warehouse.complete_rewrites()
    snapshot = warehouse.snapshot()
    if snapshot.empty:
        return
    rows = warehouse.rows(table, snapshot)
    if table == "dim_customer":
        rows = newest_versions(rows)
    current = rows.withColumn(BATCH, F.lit(snapshot.batch_id).cast("bigint"))
    warehouse.rewrite(table, current.repartitionByRange(warehouse.order(table)))


def analyze(spark: SparkSession, tables: list[str]) -> None:
    """Refreshes optimizer statistics of catalog tables (see warehouse.table_ddl)."""
    for table in tables:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def _rewrite_days(warehouse: Warehouse, days: list[int], rows: DataFrame) -> None:
    """Replaces the folders of ``days`` by ``rows``; large days are split, small ones gathered."""
    warehouse.rewrite(FACT, rows.hint("rebalance", "date_id"), days)


def table_footprint(tables: dict[str, DataFrame]) -> DataFrame:
    """Files, bytes and rows per table, from file metadata columns; no data column is read.

    Each frame must read files directly.
    """
    parts = []
    for name, df in tables.items():
        per_file = df.groupBy(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
        ).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(
            per_file.agg(
                F.count(F.lit(1)).alias("files"),
                F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
                F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            ).select(F.lit(name).alias("table_name"), "files", "bytes", "rows")
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


FOOTPRINTS = columns(taken_at=INSTANT, table_name=TEXT, files=LONG, bytes=LONG, rows=LONG)


def record_footprint(warehouse: Warehouse, at: datetime) -> None:
    """Appends the sizes of all star tables to their history, under the time given. Recorded again for
    the same time, they replace what was there."""
    spark = warehouse.spark
    present = [t for t in STAR_TABLES if files.exists(spark, warehouse.path(t))]
    absent = [(t, 0, 0, 0) for t in STAR_TABLES if t not in present]
    sizes = spark.createDataFrame(absent, columns(table_name=TEXT, files=LONG, bytes=LONG, rows=LONG))
    if present:
        sizes = sizes.unionByName(table_footprint({t: warehouse.stored(t) for t in present}))
    micros = round(at.timestamp() * 1_000_000)
    taken = F.timestamp_micros(F.lit(micros)).alias("taken_at")
    one = sizes.select(taken, *(F.col(f.name).cast(f.dataType) for f in FOOTPRINTS.fields[1:]))
    one.coalesce(1).write.mode("overwrite").parquet(f"{warehouse.root}/{FOOTPRINT}/taken={micros}")


def footprints(warehouse: Warehouse) -> DataFrame:
    """The history of sizes; a table has one row for each time they were recorded."""
    spark, path = warehouse.spark, f"{warehouse.root}/{FOOTPRINT}"
    if not files.exists(spark, path):
        return spark.createDataFrame([], FOOTPRINTS)
    return spark.read.schema(FOOTPRINTS).parquet(path)


def footprint_as_of(history: DataFrame, at: Column) -> DataFrame:
    """The newest sizes of each table that were recorded up to ``at``."""
    sizes = [f.name for f in FOOTPRINTS.fields if f.name != "table_name"]
    newest = history.filter(F.col("taken_at") <= at).groupBy("table_name").agg(F.max(F.struct(*sizes)).alias("s"))
    return newest.select("table_name", *(f"s.{c}" for c in sizes))


def storage_growth(history: DataFrame, at: Column, since: Column) -> DataFrame:
    """Each table as of ``at`` beside itself as of ``since``; the ratio of bytes is null without a size then
    or with none."""
    now = footprint_as_of(history, at).drop("taken_at")
    then = footprint_as_of(history, since).select(
        "table_name", F.col("bytes").alias("then_bytes"), F.col("rows").alias("then_rows")
    )
    ratio = F.when(F.col("then_bytes") > 0, F.col("bytes") / F.col("then_bytes"))
    return now.join(then, "table_name", "left").withColumn("ratio", ratio)


def archival_report(candidates: DataFrame, footprint: DataFrame) -> DataFrame:
    """Candidates and sizes as one table of (section, name, metric, value)."""

    def long(df: DataFrame, section: str, name: Column, metrics: list[str]) -> DataFrame:
        pairs = F.array(
            *(
                F.struct(F.lit(m).alias("metric"), F.col(m).cast("bigint").alias("value"))
                for m in metrics
            )
        )
        return df.select(
            F.lit(section).alias("section"), name.alias("name"), F.explode(pairs).alias("p")
        ).select("section", "name", "p.metric", "p.value")

    return long(
        candidates,
        "archival",
        F.lit(FACT),
        ["total_records", "archival_candidates", "retention_days"],
    ).unionByName(
        long(footprint, "storage", F.col("table_name"), ["files", "bytes", "rows"])
    )
