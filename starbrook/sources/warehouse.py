"""The star schema as partitioned Parquet, with one log row deciding what readers see.

Every table is an append-only set of ``batch_id=N`` folders (the fact table below ``date_id=D``).
N numbers the warehouse's own attempts and only rises; which batch of which feed an attempt loads is
in its log row. An attempt writes its folders first and logs success last; folders of an attempt that
never did are not read, and no attempt writes into another's folders. A batch that succeeded once is
not loaded again, so replays find it done, whatever has become of its folders since.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbrook.schemas import CUSTOMER_STATE, QUALITY_SCHEMA, REJECT_SCHEMA, RUN_LOG_SCHEMA, STAR_TABLES
from starbrook.sources import files

FACT = "fact_product_views"
REJECTS = "rejects"
RUN_LOG = "run_log"
QUALITY = "quality_counts"
BATCH = "batch_id"
REWRITE = "rewrite-"


@dataclass(frozen=True)
class Snapshot:
    """What a reader sees: everything up to the newest successful attempt that was not left
    unfinished. ``last`` is the newest attempt of any state."""

    batch_id: int | None = None
    high_water: dict[str, int] = field(default_factory=dict)
    unfinished: tuple[int, ...] = ()
    last: int = -1

    @property
    def empty(self) -> bool:
        return self.batch_id is None

    def shows(self) -> Column:
        """Predicate on the batch column."""
        if self.empty:
            return F.lit(False)
        shown = F.col(BATCH) <= self.batch_id
        return shown & ~F.col(BATCH).isin(*self.unfinished) if self.unfinished else shown


@dataclass(frozen=True)
class Written:
    """A batch folder just written, its size and its highest surrogate key."""

    rows: DataFrame
    count: int
    high: int | None


class Warehouse:
    def __init__(self, spark: SparkSession, root: str, job_id: str = "ingest"):
        self.spark, self.root, self.job_id = spark, root.rstrip("/"), job_id

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def batch_path(self, table: str, batch_id: int) -> str:
        return f"{self.path(table)}/{BATCH}={batch_id}"

    def staging_path(self, batch_id: int) -> str:
        return f"{self.root}/_staging/{BATCH}={batch_id}"

    def partitions(self, table: str) -> list[str]:
        """The columns that folders of a table are named by."""
        return ["date_id", BATCH] if table == FACT else [BATCH]

    def order(self, table: str) -> str:
        """The column that rows are sorted by within a folder: time, or the natural key."""
        names = self.schema(table).fieldNames()
        return "time_stamp" if table == FACT else next((c for c in names if c.endswith("_id")), names[0])

    def schema(self, table: str) -> T.StructType:
        """Stored columns of a table, without its batch."""
        if table == REJECTS:
            return REJECT_SCHEMA
        if table == RUN_LOG:
            return RUN_LOG_SCHEMA
        if table == QUALITY:
            return QUALITY_SCHEMA
        fields = list(STAR_TABLES[table].fields)
        if table == "dim_customer":
            fields += CUSTOMER_STATE.fields
        return T.StructType(fields)

    # reading

    def stored(self, table: str, days: list[int | None] | None = None) -> DataFrame:
        """All folders of a table, visible or not, with their batch.

        With ``days``, only those days' folders of the fact table are listed and read.
        """
        schema = T.StructType([*self.schema(table).fields, T.StructField(BATCH, T.LongType())])
        reader = self.spark.read.schema(schema)
        if not files.exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        if days is None:
            return reader.parquet(self.path(table))
        present = set(files.folders(self.spark, self.path(table)))
        names = [name for name in map(day_folder, days) if name in present]
        if not names:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path(table)}/{name}" for name in names]
        return reader.option("basePath", self.path(table)).parquet(*paths)

    def run_log(self) -> DataFrame:
        return self.stored(RUN_LOG).drop(BATCH)

    def snapshot(self, upto: int | None = None) -> Snapshot:
        """The newest state, or the one that attempt ``upto`` left."""
        good = F.col("state") == "success"
        marks = F.struct("attempt", F.map_entries("key_high_water").alias("marks"))
        log = self.run_log() if upto is None else self.run_log().filter(F.col("attempt") <= upto)
        runs = log.groupBy("attempt").agg(F.max(F.when(good, marks)).alias("c"))
        row = runs.agg(
            F.max("c").alias("c"),
            F.collect_set(F.when(F.col("c").isNull(), F.col("attempt"))).alias("unfinished"),
            F.max("attempt").alias("last"),
        ).first()
        last = -1 if row["last"] is None else row["last"]
        if row["c"] is None:
            return Snapshot(last=last)
        newest = row["c"]["attempt"]
        return Snapshot(
            newest,
            {m["key"]: m["value"] for m in row["c"]["marks"]},
            tuple(sorted(run for run in row["unfinished"] if run < newest)),
            last,
        )

    def has_loaded(self, feed: str, batch_id: int) -> bool:
        """Whether a batch of a feed has succeeded."""
        batch = (F.col("feed") == feed) & (F.col("run_id") == batch_id)
        return not self.run_log().filter(batch & (F.col("state") == "success")).isEmpty()

    def attempt_of(self, feed: str, batch_id: int) -> int | None:
        """The attempt by which a batch of a feed was loaded; None if it was not."""
        loaded = (F.col("feed") == feed) & (F.col("run_id") == batch_id) & (F.col("state") == "success")
        return self.run_log().filter(loaded).agg(F.min("attempt").alias("n")).first()["n"]

    def highest_batch(self, feed: str) -> int:
        """The largest batch number of a feed that has succeeded, or -1."""
        done = self.run_log().filter((F.col("feed") == feed) & (F.col("state") == "success"))
        return done.agg(F.coalesce(F.max("run_id"), F.lit(-1)).alias("n")).first()["n"]

    def rows(
        self, table: str, snapshot: Snapshot, days: list[int | None] | None = None
    ) -> DataFrame:
        """Visible rows with their batch; a customer may occur in several versions."""
        return self.stored(table, days).filter(snapshot.shows())

    def table(self, table: str, snapshot: Snapshot | None = None) -> DataFrame:
        """Current content, in the declared columns."""
        rows = self.rows(table, snapshot or self.snapshot())
        if table == "dim_customer":
            rows = newest_versions(rows)
        return rows.select(*STAR_TABLES[table].fieldNames())

    def as_written(self, table: str, snapshot: Snapshot) -> DataFrame:
        """Visible rows in the columns and types the files really have."""
        if not files.folders(self.spark, self.path(table)):
            return self.table(table, snapshot)
        rows = self.spark.read.parquet(self.path(table)).filter(snapshot.shows())
        return rows.drop(BATCH, *CUSTOMER_STATE.fieldNames())

    def written_by(self, table: str, attempt: int) -> DataFrame:
        """What one attempt wrote to a dimension, visible or not; only its folder is listed."""
        path = self.batch_path(table, attempt)
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], self.schema(table))
        return self.spark.read.schema(self.schema(table)).parquet(path)

    def quality_counts(self) -> DataFrame:
        """Counts kept by ``Ingest(keep_quality=True)``, of visible batches; see ``kept_quality``."""
        return self.rows(QUALITY, self.snapshot()).drop(BATCH)

    def fact(self, days: list[int | None] | None = None) -> DataFrame:
        columns = STAR_TABLES[FACT].fieldNames()
        return self.rows(FACT, self.snapshot(), days).select(*columns)

    def days(self) -> list[int]:
        """Day ids that have a folder, from folder names alone."""
        names = files.folders(self.spark, self.path(FACT))
        ids = (name.partition("=")[2] for name in names)
        return [int(value) for value in ids if value.isdigit()]

    def rejects(self) -> DataFrame:
        return self.rows(REJECTS, self.snapshot()).drop(BATCH)

    def tables(self) -> dict[str, DataFrame]:
        snapshot = self.snapshot()
        return {name: self.table(name, snapshot) for name in STAR_TABLES}

    def register_views(self) -> None:
        """Makes the star schema available to ``spark.sql`` under its table names."""
        for name, df in self.tables().items():
            df.createOrReplaceTempView(name)

    # writing

    def rewrite(self, table: str, rows: DataFrame, days: list[int | None] | None = None) -> None:
        """Replaces the content of ``days``, or of the whole table, by ``rows``, which may be read from
        the very folders that are replaced.

        The copy is staged and counted, then the folders it supersedes are listed in a table of their
        own. From then on the rewrite can be applied any number of times: the copied batch folders
        are overwritten as partitions and the listed ones are deleted. Nothing is renamed.
        """
        staged, keys = self._rewrite_path(table), self.partitions(table)
        files.delete(self.spark, f"{staged}/superseded")
        rows.sortWithinPartitions(*keys, self.order(table)).write.mode("overwrite").partitionBy(*keys).parquet(f"{staged}/rows")
        expected, found = rows.count(), self._staged_rows(table).count()
        if expected != found:
            raise RuntimeError(f"the rewritten copy has {found} rows instead of {expected}")
        gone = []
        for above in [""] if days is None else [day_folder(day) for day in days]:
            kept = files.folders(self.spark, f"{staged}/rows/{above}")
            present = files.folders(self.spark, f"{self.path(table)}/{above}")
            gone += [(f"{above}/{name}",) for name in present if name not in kept]
            if above and not kept:
                gone.append((above,))
        listed = self.spark.createDataFrame(gone, "folder string").coalesce(1)  # days times batches
        listed.write.mode("overwrite").parquet(f"{staged}/superseded")
        self._apply_rewrite(table)

    def complete_rewrites(self) -> None:
        """Applies rewrites that were cut short after their copy was complete; others are ignored.

        Called by every writer before it starts.
        """
        for name in files.folders(self.spark, f"{self.root}/_staging"):
            table = name.removeprefix(REWRITE)
            if table != name and files.exists(self.spark, f"{self._rewrite_path(table)}/superseded/_SUCCESS"):
                self._apply_rewrite(table)

    def _apply_rewrite(self, table: str) -> None:
        staged, keys = self._rewrite_path(table), self.partitions(table)
        (
            self._staged_rows(table)
            .sortWithinPartitions(*keys, self.order(table))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*keys)
            .parquet(self.path(table))
        )
        gone = self.spark.read.schema("folder string").parquet(f"{staged}/superseded")
        for row in gone.collect():
            files.delete(self.spark, f"{self.path(table)}/{row['folder']}")
        files.delete(self.spark, f"{staged}/superseded")  # first, so that half a copy is never applied
        files.delete(self.spark, staged)

    def _rewrite_path(self, table: str) -> str:
        return f"{self.root}/_staging/{REWRITE}{table}"

    def _staged_rows(self, table: str) -> DataFrame:
        schema = T.StructType([*self.schema(table).fields, T.StructField(BATCH, T.LongType())])
        return self.spark.read.schema(schema).parquet(f"{self._rewrite_path(table)}/rows")

    def log_run(
        self, feed: str, batch_id: int, attempt: int, state: str, started: datetime, **values
    ) -> None:
        """Appends one row to the log; it is built in the JVM, without a Python worker."""
        now = None if state == "running" else datetime.now(timezone.utc)
        marks = [F.lit(part) for item in values.get("high_water", {}).items() for part in item]
        row = {
            "job_id": F.lit(self.job_id),
            "feed": F.lit(feed),
            "run_id": F.lit(batch_id),
            "attempt": F.lit(attempt),
            "state": F.lit(state),
            "start_date": _instant(started),
            "end_date": _instant(now),
            "key_high_water": F.create_map(*marks) if marks else F.lit(None),
            "error": F.lit(values.get("error")),
            **{n: F.lit(values.get(n)) for n in ("input_rows", "rejected_rows", "fact_rows")},
        }
        log = self.spark.range(0, 1, 1, 1).select(
            *(row[f.name].cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA.fields)
        )
        log.write.mode("append").parquet(self.batch_path(RUN_LOG, attempt))

    def write_batch(
        self, df: DataFrame, table: str, batch_id: int, key: str | None = None
    ) -> Written | None:
        """Writes or rewrites one batch of a dimension or of the rejects, and reads it back.

        None if there was nothing to write; such a batch leaves no folder.
        """
        path, seen = self.batch_path(table, batch_id), Observation()
        highest = F.max(F.col(key) if key else F.lit(None).cast("bigint"))
        measured = df.observe(seen, F.count(F.lit(1)).alias("rows"), highest.alias("high"))
        measured.write.mode("overwrite").parquet(path)
        if not seen.get["rows"]:
            files.delete(self.spark, path)
            return None
        rows = self.spark.read.schema(self.schema(table)).parquet(path)
        return Written(rows, seen.get["rows"], seen.get["high"])

    def write_facts(self, facts: DataFrame, batch_id: int) -> int:
        """One folder per day and batch; returns the number of rows written.

        Rebalancing splits large days and gathers small ones; rows are sorted by time so that row
        groups can be skipped by their time span.
        """
        # counted in the writing stage itself, where a repeated task is not counted twice
        written = Observation()
        (
            facts.hint("rebalance", "date_id")
            .withColumn(BATCH, F.lit(batch_id).cast("bigint"))
            .observe(written, F.count(F.lit(1)).alias("rows"))
            .sortWithinPartitions("date_id", BATCH, "time_stamp")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date_id", BATCH)
            .parquet(self.path(FACT))
        )
        return written.get["rows"]


def _instant(when: datetime | None) -> Column:
    """A literal that does not depend on the driver's time zone."""
    if when is None:
        return F.lit(None)
    return F.timestamp_micros(F.lit(int(when.timestamp() * 1_000_000)))


def day_folder(day: int | None) -> str:
    return f"date_id={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"


def newest_versions(rows: DataFrame) -> DataFrame:
    """The last written version of each customer; the surrogate key is the same in all of them."""
    rest = [c for c in rows.columns if c not in ("customer_id", BATCH)]
    newest = rows.groupBy("customer_id").agg(F.max(F.struct(BATCH, *rest)).alias("v"))
    return newest.select("customer_id", *(F.col(f"v.{c}") for c in rest), F.col(f"v.{BATCH}"))


def table_ddl(root: str) -> list[str]:
    """CREATE TABLE statements for a plain copy of the star schema below ``root``."""
    statements = []
    for name, schema in STAR_TABLES.items():
        partition = " PARTITIONED BY (date_id)" if name == FACT else ""
        columns = ", ".join(
            f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}"
            for f in schema.fields
        )
        statements.append(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{partition} "
            f"LOCATION '{root.rstrip('/')}/{name}'"
        )
    return statements
