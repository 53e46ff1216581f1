"""Micro-batch ingestion: messages in, star schema out.

The same code loads a batch DataFrame (``load``) and runs inside ``foreachBatch``.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from starbrook.operators import kept_quality
from starbrook.operators.dimensions import (
    DIMENSIONS,
    Dimension,
    date_members,
    overlay_customers,
)
from starbrook.operators.facts import absent_facts, build_facts, prepare_events, touched_days
from starbrook.operators.locate import RANGE_BROADCAST_BYTES, ranges_fit
from starbrook.operators.lookup import (
    BROADCAST_BYTES,
    ROW_OVERHEAD,
    fits_broadcast,
    known_members,
    missing_members,
    size_in_bytes,
)
from starbrook.operators.numbering import number_rows
from starbrook.operators.retention import append_archive
from starbrook.schemas import STAR_TABLES
from starbrook.session import use_utc
from starbrook.sources import files
from starbrook.sources.events import parse_events
from starbrook.sources.ledger import FactLedger
from starbrook.sources.warehouse import (
    BATCH,
    FACT,
    QUALITY,
    REJECTS,
    Snapshot,
    Warehouse,
    newest_versions,
)
from starbrook.streaming.monitor import feed_of
from starbrook.streaming.suppress import state_on_disk, without_repeats

TRIGGER = "15 seconds"
LOADED = "load"  # feed of batches that no stream delivers
FACT_ID_BYTES = 64


@dataclass(frozen=True)
class Staged:
    rows: DataFrame
    count: int
    bytes: int


class Ingest:
    """Feeds one warehouse, as its only writer.

    ``archive_before`` sends facts of pruned days to the archive. With ``ledger`` new facts are found by
    its buckets, so that no history is shuffled; it must have been there from the first batch on.
    ``keep_quality`` keeps the counts that ``kept_quality`` reads, also from the first batch on.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        ip_ranges: DataFrame,
        archive_before: Column | None = None,
        range_limit: int = RANGE_BROADCAST_BYTES,
        ledger: FactLedger | None = None,
        keep_quality: bool = False,
    ):
        self.warehouse = warehouse
        self.spark: SparkSession = use_utc(warehouse.spark)
        self.ranges = ip_ranges
        self.ranges_small = ranges_fit(ip_ranges, range_limit)
        self.archive_before = archive_before
        self.ledger, self.keep_quality = ledger, keep_quality
        self._newest: Snapshot | None = None
        self._highest: dict[str, int] = {}
        warehouse.complete_rewrites()

    # drivers

    def start(
        self,
        source: DataFrame,
        checkpoint: str,
        trigger: dict | None = None,
        suppress_within: str | None = None,
    ) -> StreamingQuery:
        """Runs until stopped; late events are accepted at any age, as facts are held in no state.

        With ``suppress_within``, messages that arrived before within that span are cut before the
        lookups; repeats after longer meet the comparison with the fact table, as all do without it.
        The batch that remains is written once, so that state is read and committed once.

        The feed is the query as its checkpoint knows it, so a new checkpoint is a new feed whose
        batch numbers are not taken for those of an earlier one.
        """
        feed: list[str] = []

        def process(messages: DataFrame, batch_id: int) -> None:
            if not feed:  # written before the first batch
                feed.append(feed_of(self.spark, checkpoint))
            if suppress_within is None:
                self.process_batch(messages, batch_id, feed[0])
                return
            path = f"{self.warehouse.root}/_staging/first-{feed[0]}-{batch_id}"
            messages.write.mode("overwrite").parquet(path)
            first = self.spark.read.schema(messages.schema).parquet(path)
            self.process_batch(first, batch_id, feed[0])
            files.delete(self.spark, path)

        if suppress_within is not None:
            source = without_repeats(source, suppress_within)
        writer = (
            source.writeStream.foreachBatch(process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": TRIGGER}))
        )
        if suppress_within is None:
            return writer.start()
        with state_on_disk(self.spark):
            return writer.start()

    def process_batch(self, messages: DataFrame, batch_id: int, feed: str = LOADED) -> None:
        if messages.isEmpty():
            return
        self.load(parse_events(messages), batch_id, feed)

    def load(self, events: DataFrame, batch_id: int, feed: str = LOADED) -> None:
        """Loads one batch of parsed events. A batch that has succeeded before is left as it is; one
        that failed is loaded by a new attempt."""
        started = datetime.now(timezone.utc)
        if self._has_loaded(feed, batch_id):
            return
        base, self._newest = self._newest or self.warehouse.snapshot(), None
        attempt = base.last + 1
        try:
            outcome = self._load(events, feed, batch_id, attempt, base, started)
        except Exception as error:
            self.warehouse.log_run(feed, batch_id, attempt, "failed", started, error=str(error))
            raise
        self.warehouse.log_run(feed, batch_id, attempt, "success", started, **outcome)
        broken = range(0 if base.empty else base.batch_id + 1, attempt)
        unfinished = (*base.unfinished, *broken)
        self._newest = Snapshot(attempt, outcome["high_water"], unfinished, attempt)
        self._highest[feed] = max(batch_id, self._highest[feed])
        files.delete(self.spark, self.warehouse.staging_path(attempt))

    # one batch

    def _has_loaded(self, feed: str, batch_id: int) -> bool:
        """Numbers above the feed's highest are new; only for others the log is searched."""
        if feed not in self._highest:
            self._highest[feed] = self.warehouse.highest_batch(feed)
        return batch_id <= self._highest[feed] and self.warehouse.has_loaded(feed, batch_id)

    def _parallel(self, tasks: list) -> list:
        """Runs independent jobs side by side; each is small beside its fixed costs."""
        with ThreadPoolExecutor(len(tasks)) as pool:
            runs = [pool.submit(inheritable_thread_target(self.spark)(task)) for task in tasks]
            return [run.result() for run in runs]

    def _load(
        self,
        events: DataFrame,
        feed: str,
        batch_id: int,
        attempt: int,
        base: Snapshot,
        started: datetime,
    ) -> dict:
        # The log row marking the batch as unfinished is there before any table is touched.
        staged, _ = self._parallel(
            [
                lambda: self._stage(
                    prepare_events(events, self.ranges, self.ranges_small), attempt, "prepared"
                ),
                lambda: self.warehouse.log_run(feed, batch_id, attempt, "running", started),
            ]
        )
        prepared, rejected = staged.rows, 0
        if "reject_reason" in prepared.columns:
            bad = prepared.filter(F.col("reject_reason").isNotNull())
            rejected = bad.count()
            if rejected:
                bad = bad.select("raw_value", "reject_reason")
                self.warehouse.write_batch(bad, REJECTS, attempt)
            prepared = prepared.filter(F.col("reject_reason").isNull())

        tasks = [lambda d=d: self._upsert(d, prepared, attempt, base) for d in DIMENSIONS]
        tasks.append(lambda: self._upsert_dates(prepared, attempt, base))
        # The dimensions do not depend on each other.
        results = self._parallel(tasks)[: len(DIMENSIONS)]
        lookups = {d.table: (r[0], r[1]) for d, r in zip(DIMENSIONS, results)}

        facts = build_facts(prepared, lookups)
        inserted = self._insert(facts, prepared, staged.count, attempt, base)
        if self.ledger is not None or self.keep_quality:
            self._keep(prepared, attempt, base)
        return {
            "input_rows": staged.count,
            "rejected_rows": rejected,
            "fact_rows": inserted,
            "high_water": {d.table: r[2] for d, r in zip(DIMENSIONS, results)},
        }

    def _upsert(self, dim: Dimension, prepared: DataFrame, attempt: int, base: Snapshot):
        """Adds new members and new versions.

        Returns the keys of this batch's members, whether they are small, and the highest key.
        """
        staged = self._stage(dim.members(prepared), attempt, f"members_{dim.table}")
        members, small = staged.rows, staged.bytes <= BROADCAST_BYTES
        start = base.high_water.get(dim.table, 0)

        known, new = None, members
        if not base.empty:
            log = self.warehouse.rows(dim.table, base)
            known = known_members(members, log, dim.natural, small)
            if dim.table == "dim_customer":
                known = newest_versions(known)
            new = missing_members(members, known, dim.natural, small)

        freeze = self._freezer(attempt, f"numbered_{dim.table}")
        order = [F.col(dim.natural)]
        versions = dim.conform(
            number_rows(new, order, dim.key, start, freeze)
        )
        if known is not None and dim.table == "dim_customer":
            versions = versions.unionByName(overlay_customers(known, members, small))
        written = self.warehouse.write_batch(versions, dim.table, attempt, dim.key)
        parts = [] if known is None else [known]
        if written is not None:
            parts.append(written.rows.filter(F.col(dim.key) > start))
        keys = [part.select(dim.natural, dim.key) for part in parts] or [
            self.spark.createDataFrame([], f"{dim.natural} string, {dim.key} bigint")
        ]
        high = written.high if written is not None else start
        return reduce(DataFrame.unionByName, keys), small, max(start, high)

    def _upsert_dates(self, prepared: DataFrame, attempt: int, base: Snapshot) -> None:
        days = date_members(prepared)  # one row per calendar day
        if not base.empty:
            known = self.warehouse.rows("dim_date", base).select("date_id")
            days = days.join(known, "date_id", "left_anti")
        self.warehouse.write_batch(days, "dim_date", attempt)

    def _insert(
        self, facts: DataFrame, prepared: DataFrame, events: int, attempt: int, base: Snapshot
    ) -> int:
        """Inserts facts not seen in earlier batches; returns how many.

        Staged are small batches, whose ids are used twice, batches that are shared with the archive, and
        those for the ledger, which would be moved to facts that are dealt by id already. Others meet the
        history where the shuffle that made them unique has left them.
        """
        small = events * (FACT_ID_BYTES + ROW_OVERHEAD) <= BROADCAST_BYTES
        staged = small or self.ledger is not None
        if self.archive_before is not None or (staged and not base.empty):
            facts = self._stage(facts, attempt, "facts").rows
        if not base.empty:
            # copies of a fact have its time, so events touch the same days as the facts they become
            days, spans = touched_days(prepared.select("date_id", F.col("event_time").alias("time_stamp")))
            if self.ledger is not None:
                facts = self.ledger.absent(facts, base.shows(), days)
            else:
                existing = self.warehouse.rows(FACT, base, days).filter(spans)
                facts = absent_facts(facts, existing, small)
        if self.archive_before is not None:
            old = F.coalesce(F.col("time_stamp") < self.archive_before, F.lit(False))
            append_archive(self.warehouse, facts.filter(old))
            facts = facts.filter(~old)
        return self.warehouse.write_facts(facts, attempt)

    def _keep(self, prepared: DataFrame, attempt: int, base: Snapshot) -> None:
        """Records the ids and the counts of what this attempt wrote, from its own folders."""
        days = [row["date_id"] for row in prepared.select("date_id").distinct().collect()]  # calendar days
        written = self.warehouse.stored(FACT, days).filter(F.col(BATCH) == attempt)
        if self.ledger is not None:
            self.ledger.append(written.select("fact_id", "date_id"), attempt)
        if not self.keep_quality:
            return
        tables = {t: self.warehouse.written_by(t, attempt) for t in STAR_TABLES if t != FACT}
        replaced = None
        if not base.empty:
            log, new = self.warehouse.rows("dim_customer", base), tables["dim_customer"]
            small = fits_broadcast(new.select("customer_id"))
            replaced = newest_versions(known_members(new, log, "customer_id", small))
        counts = kept_quality.batch_counts(tables | {FACT: written}, replaced)
        self.warehouse.write_batch(counts, QUALITY, attempt)

    # staging

    def _stage(self, df: DataFrame, attempt: int, name: str) -> Staged:
        """Writes an intermediate result once, so later steps read only the columns they need and
        a lost executor costs no recomputation. Its size is measured while it is written."""
        path = f"{self.warehouse.staging_path(attempt)}/{name}"
        seen = Observation()
        measured = df.observe(
            seen, F.count(F.lit(1)).alias("rows"), size_in_bytes(df).alias("bytes")
        )
        measured.write.mode("overwrite").parquet(path)
        rows = self.spark.read.schema(df.schema).parquet(path)
        return Staged(rows, seen.get["rows"], seen.get["bytes"])

    def _freezer(self, attempt: int, name: str):
        return lambda df: self._stage(df, attempt, name).rows
