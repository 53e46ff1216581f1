"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.functions import scalars as S
from starbrook.operators import alerts, feed, kept_quality, quality, retention
from starbrook.operators.dimensions import DIMENSIONS
from starbrook.operators.facts import prepare_events
from starbrook.operators.locate import LOCATION_COLUMNS, locate
from starbrook.operators.lookup import batch_keys, fits_broadcast, resolve_keys
from starbrook.plans import reports, shaping
from starbrook.schemas import EVENT_SCHEMA, FACT_REFERENCES, STAR_TABLES
from starbrook.session import scratch_path, use_utc
from starbrook.sources.events import event_source, parse_events, to_messages
from starbrook.sources.ledger import FactLedger
from starbrook.sources.warehouse import BATCH, FACT, REJECTS, RUN_LOG, Warehouse
from starbrook.streaming.delivery import DeliveryLog, delivery_totals, read_deliveries
from starbrook.streaming.ingest import LOADED, Ingest
from starbrook.streaming.mirror import start_mirror
from starbrook.streaming.monitor import (
    read_lag,
    read_lag_percentiles,
    read_throughput,
    start_lag,
    start_lag_sketches,
    start_throughput,
)

Query = Callable[[SparkSession, str], DataFrame]

COUNTRY = "NATION_7"
AS_OF = "2024-02-10 00:00:00"
JOBS_AS_OF = "2024-01-31 00:00:00"
JOBS_WINDOW_MINUTES = 1440
EXPECTED_MINIMUM = 8
EVENT_LIMIT_MILLIS = 60_000
LEDGER_BUCKETS = 8
LOADED_AT = datetime(2024, 2, 8, tzinfo=timezone.utc)

_stars: dict[tuple[str, str, str], Warehouse] = {}


def _wire(df: DataFrame) -> DataFrame:
    return df.select(*EVENT_SCHEMA.fieldNames())


def _new_warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, label))


def _load_once(spark: SparkSession, sf_dir: str) -> Warehouse:
    warehouse = _new_warehouse(spark, "star")
    feed_rows = _wire(shaping.raw_events(spark, sf_dir, dealt=True))
    Ingest(warehouse, shaping.ip_ranges(spark, sf_dir)).load(feed_rows, 0)
    return warehouse


def _load_slices(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Three deliveries, whose sizes are recorded as if they came on days of their own; the repeated
    purchases of one arrive with the next."""
    warehouse = _new_warehouse(spark, "slices")
    ingest = Ingest(warehouse, shaping.ip_ranges(spark, sf_dir))
    raw = shaping.raw_events(spark, sf_dir, dealt=True)
    for number in range(shaping.LAST_SLICE + 1):
        ingest.load(_wire(raw.filter(F.col("slice") == number)), number)
        retention.record_footprint(warehouse, LOADED_AT + number * timedelta(days=1))
    return warehouse


def _load_kept(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The deliveries of ``slices`` and the last once more, with counts kept and new facts found by the
    ledger, which is opened anew for each as after a restart."""
    warehouse = _new_warehouse(spark, "kept")
    ranges, raw = shaping.ip_ranges(spark, sf_dir), shaping.raw_events(spark, sf_dir, dealt=True)
    name = "fact_ledger_" + warehouse.root.rpartition("-")[2]
    for number in [*range(shaping.LAST_SLICE + 1), shaping.LAST_SLICE]:
        ledger = FactLedger(spark, name, f"{warehouse.root}/_ledger", LEDGER_BUCKETS)
        ingest = Ingest(warehouse, ranges, ledger=ledger, keep_quality=True)
        ingest.load(_wire(raw.filter(F.col("slice") == number)), number)
        spark.sql(f"DROP TABLE {name}")  # known to the session alone; its files stay
    return warehouse


def _load_stream(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The same deliveries as message files, each picked up by a restarted streaming query."""
    warehouse = _new_warehouse(spark, "streamed")
    ingest = Ingest(warehouse, shaping.ip_ranges(spark, sf_dir))
    inbox, checkpoint = f"{warehouse.root}/_inbox", f"{warehouse.root}/_checkpoint"
    raw = shaping.raw_events(spark, sf_dir, dealt=True)
    for number in range(shaping.LAST_SLICE + 1):
        to_messages(raw.filter(F.col("slice") == number)).write.mode("append").parquet(inbox)
        source = event_source(spark, "parquet", inbox)
        query = ingest.start(source, checkpoint, trigger={"availableNow": True})
        query.awaitTermination()
    return warehouse


def _load_suppressed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The deliveries of ``stream`` with each message up to three times, by the number of its event: once
    more in its own micro-batch, and once more in the next, which a restarted query reads."""
    warehouse = _new_warehouse(spark, "suppressed")
    ingest = Ingest(warehouse, shaping.ip_ranges(spark, sf_dir))
    inbox, checkpoint = f"{warehouse.root}/_inbox", f"{warehouse.root}/_checkpoint"
    raw, times = shaping.raw_events(spark, sf_dir, dealt=True), F.col("id").cast("bigint") % 3
    with _listening(spark, f"{warehouse.root}/_deliveries") as log:
        for number in range(shaping.LAST_SLICE + 2):
            now = raw.filter(F.col("slice") == number)
            again = raw.filter((F.col("slice") == number - 1) & (times >= 1))
            messages = now.unionByName(now.filter(times == 2)).unionByName(again)
            to_messages(messages).write.mode("append").parquet(inbox)
            query = ingest.start(
                event_source(spark, "parquet", inbox),
                checkpoint,
                trigger={"availableNow": True},
                suppress_within="7 days",
            )
            query.awaitTermination()
            log.wait(query)
    return warehouse


@contextmanager
def _listening(spark: SparkSession, path: str):
    log = DeliveryLog(spark, path)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)


_LOADERS = {
    "once": _load_once,
    "slices": _load_slices,
    "kept": _load_kept,
    "stream": _load_stream,
    "suppressed": _load_suppressed,
}


def star(spark: SparkSession, sf_dir: str, how: str = "once") -> Warehouse:
    """The star schema of a test folder, ingested on first use and then read from Parquet."""
    use_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir, how)
    if key not in _stars:
        _stars[key] = _LOADERS[how](spark, sf_dir)
    return _stars[key]


def _copy(source: Warehouse) -> Warehouse:
    """A warehouse of its own for jobs that rewrite folders."""
    target = _new_warehouse(source.spark, "copy")
    for table in [*STAR_TABLES, REJECTS, RUN_LOG]:
        parts = ["date_id", BATCH] if table == FACT else [BATCH]
        rows = source.stored(table).hint("rebalance", *parts)
        rows.write.mode("append").partitionBy(*parts).parquet(target.path(table))
    return target


def _latest(warehouse: Warehouse):
    return reports.latest_report_date(warehouse.fact()).first()["max_date"]


def _latest_fact(warehouse: Warehouse):
    """The newest day and the fact rows of its folder."""
    day = _latest(warehouse)
    return day, warehouse.fact([reports.day_id(day)])


def _utc(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir.rstrip("/"))

    return run


# parsing and scalars


def event_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = shaping.raw_events(spark, sf_dir)
    broken = F.concat(F.lit("not json "), F.col("key").cast("string")).cast("binary")
    messages = to_messages(raw).withColumn(
        "value", F.when(F.col("key").cast("string").cast("bigint") % 71 == 0, broken).otherwise(F.col("value"))
    )
    parsed = parse_events(messages)
    return parsed.select(*_event_columns(), "reject_reason", "raw_value")


def _event_columns() -> list:
    """All fields of an event, the whole array of options as JSON."""
    return [F.to_json(c).alias(c) if c == "option" else F.col(c) for c in EVENT_SCHEMA.fieldNames()]


def iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("i")
    text = (
        F.when(i % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+07:00'"))
        .when(i % 3 == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"))
        .otherwise(F.concat(F.lit("invalid-"), i.cast("string")))
    )
    rows = shaping.events(spark, sf_dir).select(i.alias("event_id"), text.alias("iso_text"))
    return rows.withColumn("iso_date", S.iso_date(F.col("iso_text")))


def epoch_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamp = F.col("time_stamp")
    return shaping.raw_events(spark, sf_dir).select(
        "id",
        "time_stamp",
        S.epoch_millis(stamp).alias("event_millis"),
        S.event_time(stamp).alias("event_time"),
        S.date_id(S.event_time(stamp)).alias("date_id"),
    )


def ip_geolocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = locate(shaping.raw_events(spark, sf_dir), shaping.ip_ranges(spark, sf_dir))
    return located.select("id", "ip", *(f"loc_info.{c}" for c in LOCATION_COLUMNS))


def ip_geolocate_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup on the path taken when the ranges are too large to broadcast."""
    raw, ranges = shaping.raw_events(spark, sf_dir), shaping.ip_ranges(spark, sf_dir)
    located = locate(raw, ranges, ranges_small=False)
    return located.select("id", "ip", *(f"loc_info.{c}" for c in LOCATION_COLUMNS))


# star schema


def _table(name: str, how: str = "once") -> Query:
    return lambda spark, sf_dir: star(spark, sf_dir, how).table(name)


def dimension_incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural and surrogate keys of all dimensions after three deliveries."""
    warehouse = star(spark, sf_dir, "slices")
    parts = [
        warehouse.table(d.table).select(
            F.lit(d.table).alias("dimension"),
            F.col(d.natural).alias("natural_id"),
            F.col(d.key).alias("surrogate_key"),
        )
        for d in DIMENSIONS
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def batch_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the members a delivery mentions: the last of three, after the first two."""
    warehouse = star(spark, sf_dir, "slices")
    before = warehouse.snapshot(upto=warehouse.attempt_of(LOADED, shaping.LAST_SLICE - 1))
    raw = shaping.raw_events(spark, sf_dir).filter(F.col("slice") == shaping.LAST_SLICE)
    prepared = prepare_events(_wire(raw), shaping.ip_ranges(spark, sf_dir))
    keys = batch_keys(prepared, {d.table: d.event_column for d in DIMENSIONS})
    tables = {d.table: warehouse.rows(d.table, before).select(d.natural, d.key) for d in DIMENSIONS}
    return resolve_keys(keys, tables, fits_broadcast(keys))


# reports


def latest_report_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_report_date(star(spark, sf_dir).fact())


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = star(spark, sf_dir)
    day, fact = _latest_fact(warehouse)
    return reports.top_products(fact, warehouse.table("dim_product"), day)


def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = star(spark, sf_dir)
    day, fact = _latest_fact(warehouse)
    return reports.top_countries(fact, warehouse.table("dim_location"), day)


def top_referrers(spark: SparkSession, sf_dir: str) -> DataFrame:
    day, fact = _latest_fact(star(spark, sf_dir))
    return reports.top_referrers(fact, day)


def country_store_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = star(spark, sf_dir)
    day, fact = _latest_fact(warehouse)
    locations, stores = warehouse.table("dim_location"), warehouse.table("dim_store")
    return reports.country_store_views(fact, locations, stores, COUNTRY, day)


def country_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.country_list(star(spark, sf_dir).table("dim_location"))


def recent_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = star(spark, sf_dir)
    day, fact = _latest_fact(warehouse)
    return reports.recent_products(fact, warehouse.table("dim_product"), day)


def product_hourly_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day of its most viewed product."""
    warehouse = star(spark, sf_dir)
    day, fact = _latest_fact(warehouse)
    products = warehouse.table("dim_product")
    leader = reports.top_products(fact, products, day, 1).first()["product_id"]
    return reports.product_hourly_views(fact, products, leader, day)


def product_total_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.product_total_views(product_hourly_views(spark, sf_dir))


def browser_os_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = star(spark, sf_dir)
    day, fact = _latest_fact(warehouse)
    return reports.browser_os_views(fact, warehouse.table("dim_device"), day)


def browser_os_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = star(spark, sf_dir)
    day, fact = _latest_fact(warehouse)
    return reports.browser_os_totals(fact, warehouse.table("dim_device"), day)


# quality


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.completeness(star(spark, sf_dir).tables())


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = star(spark, sf_dir)
    snapshot = warehouse.snapshot()
    return quality.schema_check({t: warehouse.as_written(t, snapshot) for t in STAR_TABLES})


def kept_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables after three deliveries and a replay, from the counts kept with them."""
    return kept_quality.completeness(star(spark, sf_dir, "kept").quality_counts())


def kept_completeness_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kept_quality.completeness_by_day(star(spark, sf_dir, "kept").quality_counts())


def kept_error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's counts as kept, against dimensions that know the members of the first day only."""
    kept = star(spark, sf_dir, "kept").quality_counts()
    found = kept_quality.error_rate(kept, _lagging_tables(spark, sf_dir, "kept"), EXPECTED_MINIMUM)
    return found.filter((F.col("table_name") == FACT))


def _lagging_tables(spark: SparkSession, sf_dir: str, how: str = "once") -> dict[str, DataFrame]:
    """Dimensions that stopped being maintained after the first day, so later members are orphans."""
    tables = star(spark, sf_dir, how).tables()
    fact = tables[FACT]
    first = fact.agg(F.min("date_id").alias("d")).first()["d"]
    day = fact.filter(F.col("date_id") == first)
    for fact_key, (dim, dim_key) in FACT_REFERENCES.items():
        seen = day.select(F.col(fact_key).alias(dim_key)).distinct()
        tables[dim] = tables[dim].join(seen, dim_key, "left_semi")
    return tables


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.orphan_report(_lagging_tables(spark, sf_dir))


def error_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.error_rate(_lagging_tables(spark, sf_dir), EXPECTED_MINIMUM)


def duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = shaping.read(spark, sf_dir, "lineitem")
    parts = [
        quality.duplicates(lines, ["l_orderkey", "l_linenumber"], "lineitem"),
        quality.duplicates(shaping.raw_events(spark, sf_dir), ["product_id"], "raw_events"),
        quality.duplicates(star(spark, sf_dir).fact(), ["fact_id"], FACT),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    star(spark, sf_dir).register_views()
    shaping.raw_events(spark, sf_dir).createOrReplaceTempView("raw_events")
    more = [
        {
            "name": "feed_has_no_repeats",
            "sql": "SELECT count(*) - count(DISTINCT id) FROM raw_events",
            "expected_result": 0,
        },
        {
            "name": "unknown_column",
            "sql": "SELECT count(no_such_column) FROM fact_product_views",
            "expected_result": 0,
        },
    ]
    return quality.run_expectations(spark, [*quality.BUSINESS_RULES, *more])


def expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _expectations(spark, sf_dir).drop("error")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _expectations(spark, sf_dir)
    return quality.quality_report(star(spark, sf_dir).tables(), found, EXPECTED_MINIMUM)


# retention


def _as_of(text: str = AS_OF):
    return F.lit(text).cast("timestamp")


def archival_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return retention.archival_candidates(star(spark, sf_dir).fact(), _as_of())


def retention_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    expired, kept = retention.split_by_age(star(spark, sf_dir).fact(), _as_of())

    def per_day(df: DataFrame, side: str) -> DataFrame:
        counted = df.groupBy("date_id").agg(F.count(F.lit(1)).alias("rows"))
        return counted.select(F.lit(side).alias("side"), "date_id", "rows")

    return per_day(expired, "archive").unionByName(per_day(kept, "live"))


def archive_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live and archived facts after a retention run at noon, so that one day is split."""
    warehouse = _copy(star(spark, sf_dir, "slices"))
    retention.archive_old_facts(warehouse, _as_of("2024-02-10 12:00:00"))
    sides = [("live", warehouse.fact()), ("archive", retention.read_archive(warehouse))]
    parts = [df.select(F.lit(side).alias("side"), "fact_id", "date_id") for side, df in sides]
    return parts[0].unionByName(parts[1])


def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact table after all its days and the customers were compacted; content must not change."""
    warehouse = _copy(star(spark, sf_dir, "slices"))
    retention.compact_fact_days(warehouse, warehouse.days())
    retention.compact_dimension(warehouse, "dim_customer")
    customers = warehouse.table("dim_customer").select("customer_key", "customer_id", "email_address")
    return warehouse.fact().join(customers, "customer_key", "left").select(
        "fact_id", "customer_key", "customer_id", "email_address", "date_id"
    )


def _replayed(rerun) -> Query:
    """The facts with their customers after the three deliveries and then ``rerun``, which must not
    change them."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = _copy(star(spark, sf_dir, "slices"))
        raw, ranges = shaping.raw_events(spark, sf_dir, dealt=True), shaping.ip_ranges(spark, sf_dir)
        rerun(warehouse, ranges, raw, shaping.LAST_SLICE)
        customers = warehouse.table("dim_customer").select("customer_key", "customer_id", "email_address")
        return warehouse.fact().join(customers, "customer_key", "left").select(
            "fact_id", "customer_key", "customer_id", "email_address", "date_id"
        )

    return run


def _after_compaction(warehouse: Warehouse, ranges: DataFrame, raw: DataFrame, last: int) -> None:
    """The newest delivery once more, as after a stop before the checkpoint was written."""
    retention.compact_fact_days(warehouse, warehouse.days())
    retention.compact_dimension(warehouse, "dim_customer")
    Ingest(warehouse, ranges).load(_wire(raw.filter(F.col("slice") == last)), last)


def _by_new_checkpoint(warehouse: Warehouse, ranges: DataFrame, raw: DataFrame, last: int) -> None:
    """The newest delivery from a stream of its own, which begins to count anew."""
    inbox, checkpoint = f"{warehouse.root}/_inbox", f"{warehouse.root}/_checkpoint"
    to_messages(raw.filter(F.col("slice") == last)).write.parquet(inbox)
    source = event_source(warehouse.spark, "parquet", inbox)
    Ingest(warehouse, ranges).start(source, checkpoint, trigger={"availableNow": True}).awaitTermination()


def _with_fewer_days(warehouse: Warehouse, ranges: DataFrame, raw: DataFrame, last: int) -> None:
    """A repeat of the newest delivery that lacks most of its days."""
    part = raw.filter((F.col("slice") == last) & (F.dayofmonth("ts") <= 25))
    Ingest(warehouse, ranges).load(_wire(part), last)


def table_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = star(spark, sf_dir)
    return retention.table_footprint({t: warehouse.stored(t) for t in warehouse.tables()})


def storage_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after the last of three deliveries beside the first, and whether the bytes recorded are
    those of its files as listed, and grew by more than the standing rule allows."""
    warehouse = star(spark, sf_dir, "slices")
    first, last = LOADED_AT, LOADED_AT + shaping.LAST_SLICE * timedelta(days=1)
    times = [F.timestamp_seconds(F.lit(int(t.timestamp()))) for t in (last, first)]
    found = retention.storage_growth(retention.footprints(warehouse), *times).filter(F.col("table_name") == FACT)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
        "recursiveFileLookup", "true"
    ).load(warehouse.path(FACT)).agg(F.sum("length").alias("listed"))
    return found.crossJoin(listed).select(  # one row each
        "table_name",
        "then_rows",
        "rows",
        (F.col("bytes") == F.col("listed")).alias("as_listed"),
        (F.col("ratio") > 1.5).alias("unusual"),
    )


def archival_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = archival_candidates(spark, sf_dir)
    return retention.archival_report(found, table_footprint(spark, sf_dir))


# alerts


def _alerts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Triggered alerts, and the rules that could not be evaluated: one asks for a missing column."""
    as_of = _as_of()
    fact, raw = star(spark, sf_dir).fact(), shaping.raw_events(spark, sf_dir)
    runs = shaping.job_runs(spark, sf_dir)
    feed_rules = [
        {
            "name": "feed_repeats",
            "description": "The feed delivered messages twice",
            "severity": "MEDIUM",
            "check_type": "data_quality",
            "table_name": "raw_events",
            "threshold": 0.0,
        },
        {
            "name": "feed_small",
            "description": "The feed has too few messages",
            "severity": "NOTICE",
            "check_type": "table_count",
            "table_name": "raw_events",
            "threshold": 1e12,
        },
        {
            "name": "feed_late",
            "description": "The feed is late",
            "severity": "HIGH",
            "check_type": "data_freshness",
            "table_name": "arrivals",
        },
    ]

    def storage() -> DataFrame:
        """The fact as last recorded, beside its size after the first delivery."""
        history = retention.footprints(star(spark, sf_dir, "slices"))
        now, then = (retention.footprint_as_of(history, t) for t in (as_of, _as_of(str(LOADED_AT)[:19])))
        return alerts.storage_metric(now, then, FACT)

    tables = {
        FACT: (fact, [alerts.row_count(), alerts.freshness("time_stamp"), alerts.surplus("fact_id")]),
        "raw_events": (raw, [alerts.row_count(), alerts.freshness("ts"), alerts.surplus("id")]),
        "arrivals": (raw, [alerts.freshness("arrived")]),
    }
    derived = [
        ("storage_check", FACT, storage),
        (
            "dag_failure",
            "run_log",
            lambda: alerts.failed_job_metric(runs, _as_of(JOBS_AS_OF), "run_log", JOBS_WINDOW_MINUTES),
        ),
    ]
    rules = alerts.rules_frame(spark, [*alerts.ALERT_RULES, *feed_rules])
    metrics, failures = alerts.measure(spark, tables, derived)
    return alerts.evaluate_rules(rules, [metrics], as_of), alerts.skipped_rules(rules, failures)


def alert_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir)[0].drop("triggered_at")


def alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_summary(_alerts(spark, sf_dir)[0])


def alert_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.classify(_alerts(spark, sf_dir)[0]).select("severity", "place", "name")


def alerts_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.regexp_extract("error", r"^\[([A-Z_.]+)\]", 1)
    return _alerts(spark, sf_dir)[1].select("name", "severity", reason.alias("reason"))


def failed_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = shaping.job_runs(spark, sf_dir)
    return alerts.failed_jobs(runs, _as_of(JOBS_AS_OF), JOBS_WINDOW_MINUTES)


# feed


def _with_arrival(events: DataFrame) -> DataFrame:
    behind = F.round(F.col("value") * 1000).cast("bigint")
    return events.withColumn("arrival", F.timestamp_millis(F.unix_millis("ts") + behind))


def feed_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.throughput(shaping.events(spark, sf_dir), "ts", by="event_type")


def feed_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_arrival(shaping.events(spark, sf_dir))
    return feed.lag(rows, "ts", "arrival", limit_millis=EVENT_LIMIT_MILLIS)


def feed_lag_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed.lag_percentiles(_with_arrival(shaping.events(spark, sf_dir)), "ts", "arrival")


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = shaping.read(spark, sf_dir, "events").schema
    files_only = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    return _with_arrival(
        files_only.parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    )


def stream_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "throughput")
    stream = _events_stream(spark, sf_dir)
    start_throughput(
        stream, "ts", f"{out}/data", f"{out}/state", trigger={"availableNow": True}
    ).awaitTermination()
    return read_throughput(spark, f"{out}/data")


def stream_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "lag")
    stream = _events_stream(spark, sf_dir)
    start_lag(
        stream, "ts", "arrival", f"{out}/data", f"{out}/state", trigger={"availableNow": True}
    ).awaitTermination()
    return read_lag(spark, f"{out}/data")


def suppressed_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages delivered, cut by state before the lookups, looked up, and new as facts."""
    warehouse = star(spark, sf_dir, "suppressed")
    log = delivery_totals(read_deliveries(spark, f"{warehouse.root}/_deliveries"))
    runs = warehouse.run_log().filter(F.col("state") == "success")
    loaded = runs.agg(F.sum("input_rows").alias("looked_up"), F.sum("fact_rows").alias("facts"))
    return log.crossJoin(loaded).select(  # one row each
        F.col("read_rows").alias("delivered"), F.col("repeats_cut").alias("cut"), "looked_up", "facts"
    )


MIRROR_FILES = (64, 48)
# A micro-batch reads one file; by its row groups more than one task can share it.
MIRROR_BLOCK_BYTES = 4 * 1024 * 1024


def _deliver(messages: DataFrame, files: int, path: str) -> None:
    writer = messages.repartition(files).write.mode("append")
    writer.option("parquet.block.size", MIRROR_BLOCK_BYTES).parquet(path)


def mirror_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of a mirror over more than a hundred micro-batches and a restart, from its delivery log."""
    out = scratch_path(spark, "deliveries")
    messages = to_messages(shaping.raw_events(spark, sf_dir))
    half = F.col("key").cast("string").cast("bigint") % 2 == 0
    with _listening(spark, f"{out}/log") as log:
        for part, files in zip((messages.filter(half), messages.filter(~half)), MIRROR_FILES, strict=True):
            _deliver(part, files, f"{out}/from")
            source = event_source(spark, "parquet", f"{out}/from", maxFilesPerTrigger="1")
            query = start_mirror(
                source, "parquet", f"{out}/state", f"{out}/to", trigger={"availableNow": True}
            )
            query.awaitTermination()
            log.wait(query)
    return delivery_totals(read_deliveries(spark, f"{out}/log")).drop("query", "delivered_bytes")


def stream_lag_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of the lag per day from sketches of each micro-batch, held against the events: whether
    each is within the stated error of its rank."""
    out = scratch_path(spark, "sketches")
    rows = _with_arrival(shaping.events(spark, sf_dir)).select("ts", "arrival")
    rows.repartition(4).write.parquet(f"{out}/from")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/from")
    start_lag_sketches(
        stream, "ts", "arrival", f"{out}/data", f"{out}/state", "1 day", trigger={"availableNow": True}
    ).awaitTermination()
    found = read_lag_percentiles(spark, f"{out}/data")
    errors = feed.rank_errors(rows, "ts", "arrival", found, "1 day")
    near = [(F.col(c) <= feed.RANK_ERROR).alias(f"{c[:3]}_near") for c in feed.SHARES]
    return found.join(errors.select("window_start", *near), "window_start").select(
        "window_start", "window_end", "events", *(f"{c[:3]}_near" for c in feed.SHARES)
    )


def stream_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = star(spark, sf_dir, "stream").run_log().filter(F.col("state") == "success")
    return log.select("run_id", "input_rows", "rejected_rows", "fact_rows")


def mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages after being copied from one set of files to another."""
    out = scratch_path(spark, "mirror")
    to_messages(shaping.raw_events(spark, sf_dir)).write.parquet(f"{out}/from")
    source = event_source(spark, "parquet", f"{out}/from")
    start_mirror(
        source, "parquet", f"{out}/state", f"{out}/to", trigger={"availableNow": True}
    ).awaitTermination()
    copied = spark.read.parquet(f"{out}/to")
    value = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    headers = F.transform("headers", lambda h: F.concat_ws("=", h["key"], h["value"].cast("string")))
    whole = copied.select(
        F.col("key").cast("string").alias("message_key"), F.array_join(headers, ",").alias("headers"), value.alias("event")
    ).select("message_key", "headers", "event.*")
    return whole.select("message_key", "headers", *_event_columns())


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        "event_parse": event_parse,
        "iso_dates": iso_dates,
        "epoch_normalize": epoch_normalize,
        "ip_geolocate": ip_geolocate,
        "ip_geolocate_distinct": ip_geolocate_distinct,
        "date_dimension": _table("dim_date"),
        "store_dimension": _table("dim_store"),
        "product_dimension": _table("dim_product"),
        "customer_dimension": _table("dim_customer"),
        "device_dimension": _table("dim_device"),
        "location_dimension": _table("dim_location"),
        "fact_build": _table(FACT),
        "fact_incremental_upsert": _table(FACT, "slices"),
        "fact_ledger_upsert": _table(FACT, "kept"),
        "customer_incremental_upsert": _table("dim_customer", "slices"),
        "dimension_incremental_upsert": dimension_incremental_upsert,
        "batch_key_lookup": batch_key_lookup,
        "stream_ingest": _table(FACT, "stream"),
        "stream_run_log": stream_run_log,
        "stream_ingest_suppressed": _table(FACT, "suppressed"),
        "suppressed_repeats": suppressed_repeats,
        "latest_report_date": latest_report_date,
        "top_products": top_products,
        "top_countries": top_countries,
        "top_referrers": top_referrers,
        "country_store_views": country_store_views,
        "country_list": country_list,
        "recent_products": recent_products,
        "product_hourly_views": product_hourly_views,
        "product_total_views": product_total_views,
        "browser_os_views": browser_os_views,
        "browser_os_totals": browser_os_totals,
        "completeness": completeness,
        "kept_completeness": kept_completeness,
        "kept_completeness_by_day": kept_completeness_by_day,
        "kept_error_rate": kept_error_rate,
        "schema_check": schema_check,
        "orphans": orphans,
        "duplicates": duplicates,
        "error_rate": error_rate,
        "expectations": expectations,
        "quality_report": quality_report,
        "archival_candidates": archival_candidates,
        "retention_split": retention_split,
        "archive_run": archive_run,
        "compact": compact,
        "replay_after_compaction": _replayed(_after_compaction),
        "new_checkpoint": _replayed(_by_new_checkpoint),
        "repeat_with_fewer_days": _replayed(_with_fewer_days),
        "table_footprint": table_footprint,
        "storage_growth": storage_growth,
        "archival_report": archival_report,
        "alerts": alert_list,
        "alert_summary": alert_summary,
        "alert_classes": alert_classes,
        "alerts_skipped": alerts_skipped,
        "failed_jobs": failed_jobs,
        "feed_throughput": feed_throughput,
        "feed_lag": feed_lag,
        "feed_lag_percentiles": feed_lag_percentiles,
        "stream_throughput": stream_throughput,
        "stream_lag": stream_lag,
        "stream_lag_percentiles": stream_lag_percentiles,
        "mirror": mirror,
        "mirror_deliveries": mirror_deliveries,
    }
    return {name: _utc(query) for name, query in registered.items()}
