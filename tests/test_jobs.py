"""Quality, alerts, feed, mirror and connector settings."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from starbrook.operators import alerts, feed, quality, retention
from starbrook.operators.retention import FOOTPRINTS, analyze
from starbrook.plans import reports
from starbrook.schemas import FACT_REFERENCES, STAR_TABLES
from starbrook.sources import jdbc
from starbrook.sources.events import event_source, kafka_options
from starbrook.sources.warehouse import FACT, Warehouse, table_ddl
from starbrook.streaming import delivery
from starbrook.streaming.mirror import start_mirror
from starbrook.streaming.suppress import without_repeats


def at(text):
    return F.lit(text).cast("timestamp")


# quality


def test_completeness_of_two_columns(spark):
    data = [(None if i < 5 else i, i) for i in range(100)]
    df = spark.createDataFrame(data, "a int, b int")
    found = quality.completeness({"t": df, "empty": df.limit(0)})
    assert rows(found, "table_name", "total_rows", "completeness_pct", "grade") == [
        ("empty", 0, 100.0, "ok"),
        ("t", 100, 97.5, "ok"),
    ]
    assert rows(quality.column_nulls(df, "t"), "column_name", "null_count") == [("a", 5), ("b", 0)]


def test_completeness_reads_a_table_once(spark, tmp_path):
    spark.range(10).selectExpr("id", "id as b").write.parquet(str(tmp_path / "t"))
    nulls = quality.column_nulls(spark.read.parquet(str(tmp_path / "t")), "t")
    assert nulls._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize("share, grade", [(0.9, "ok"), (0.89, "warn"), (0.7, "warn"), (0.69, "fail")])
def test_grades(spark, share, grade):
    df = spark.range(100).select(F.when(F.col("id") < int(share * 100), 1).alias("a"))
    assert quality.completeness({"t": df}).first()["grade"] == grade


def test_duplicates(spark):
    df = spark.createDataFrame([(i % 10, None) for i in range(15)], "k int, n int")
    assert quality.duplicates(df, ["k"], "t").first()["duplicate_rows"] == 5
    assert quality.duplicates(df, ["n"], "t").first()["duplicate_rows"] == 15
    assert quality.duplicates(df, ["k", "n"], "t").first()["duplicate_rows"] == 15
    assert quality.duplicates(df.limit(0), ["k"], "t").first()["duplicate_rows"] == 0


def test_orphans(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "product_key bigint")
    dim = spark.createDataFrame([(1,), (9,)], "product_key bigint")
    found = quality.orphans(fact, dim, "product_key", "product_key", "c").first()
    assert tuple(found) == ("c", 5, 2, 2, 1)


def test_schema_check(spark):
    good = spark.createDataFrame([], STAR_TABLES["dim_store"])
    assert {r["status"] for r in quality.schema_check({"dim_store": good}).collect()} == {"ok"}
    bad = spark.createDataFrame([(None, 5, "x")], "store_key bigint, store_id int, more string")
    found = {r["column_name"]: r["status"] for r in quality.schema_check({"dim_store": bad}).collect()}
    assert found == {
        "store_key": "null_violation",
        "store_id": "type_mismatch",
        "store_name": "missing",
        "more": "unexpected",
    }


def test_expectations(spark):
    checks = [
        {"name": "good", "sql": "select 10", "expected_result": 10},
        {"name": "bad", "sql": "select 5", "expected_result": 10},
        {"name": "none", "sql": "select 1 where false", "expected_result": 1},
        {"name": "broken", "sql": "select nothing from nowhere", "expected_result": 0},
        {"sql": "select 0", "expected_result": 0},
    ]
    found = {r["name"]: (r["actual"], r["status"]) for r in quality.run_expectations(spark, checks).collect()}
    assert found == {
        "good": ("10", "passed"),
        "bad": ("5", "failed"),
        "none": (None, "failed"),
        "broken": (None, "error"),
        "select 0": ("0", "passed"),
    }
    failing = {"name": "at run time", "sql": "select raise_error('no')", "expected_result": 0}
    mixed = {r["name"]: (r["actual"], r["status"]) for r in quality.run_expectations(spark, [*checks, failing]).collect()}
    assert mixed == found | {"at run time": (None, "error")}
    assert quality.run_expectations(spark, []).collect() == []
    quality.run_expectations(spark, checks[:1], raise_on_fail=True)
    with pytest.raises(quality.QualityError) as raised:
        quality.run_expectations(spark, checks, raise_on_fail=True)
    assert all(name in str(raised.value) for name in ("bad", "none", "broken"))


def test_expectations_run_side_by_side(spark, monkeypatch):
    runs = []
    plain = quality._side_by_side
    monkeypatch.setattr(quality, "_side_by_side", lambda s, frames: runs.append(len(frames)) or plain(s, frames))
    checks = [
        {"name": "two columns", "sql": "select 7 as a, 8 as a", "expected_result": 7},
        {"name": "null", "sql": "select cast(null as int)", "expected_result": None},
        {"name": "first", "sql": "select id from range(9) order by id desc", "expected_result": 8},
    ]
    assert {r["status"] for r in quality.run_expectations(spark, checks).collect()} == {"passed"}
    assert runs == [3]


# alerts


def fact(spark, *times):
    data = [(f"f{i}", t) for i, t in enumerate(times)]
    return spark.createDataFrame(data, "fact_id string, t string").select(
        "fact_id", F.col("t").cast("timestamp").alias("time_stamp")
    )


def evaluate(spark, df, as_of):
    metrics = [alerts.count_and_freshness(df, FACT), alerts.duplicate_metric(df, FACT)]
    return alerts.evaluate_rules(alerts.rules_frame(spark), metrics, at(as_of))


def test_empty_table_triggers_only_the_count_rule(spark):
    assert rows(evaluate(spark, fact(spark).limit(0), "2024-01-01 00:00:00"), "name") == [("fact_table_empty",)]


def test_freshness_limit_is_exclusive(spark):
    df = fact(spark, "2024-01-01 10:00:00")
    assert evaluate(spark, df, "2024-01-01 10:10:00").count() == 0
    alert = evaluate(spark, df, "2024-01-01 10:10:01").first()
    assert alert["description"] == (
        "Streaming stuck: No new data in fact_product_views since 10:00:00 (>10 mins delay)"
    )
    assert (alert["severity"], alert["priority"]) == ("HIGH", 2)


def test_order_classes_and_summary(spark):
    df = fact(spark, "2024-01-01 10:00:00").unionByName(fact(spark, "2024-01-01 10:00:00"))
    runs = spark.createDataFrame(
        [("b", "failed", "2024-01-01 11:50:00"), ("a", "failed", "2024-01-01 11:45:00"),
         ("a", "failed", "2024-01-01 11:59:00"), ("c", "failed", "2024-01-01 11:44:59"),
         ("d", "success", "2024-01-01 11:59:00"), ("e", "running", None)],
        "job_id string, state string, e string",
    ).select("job_id", "state", F.col("e").cast("timestamp").alias("end_date"))
    now = at("2024-01-01 12:00:00")
    sizes = [spark.createDataFrame([(FACT, n)], "table_name string, bytes bigint") for n in (200, 100)]
    odd = {"name": "odd", "description": "d", "severity": "NOTICE", "check_type": "table_count",
           "table_name": FACT, "threshold": 100.0}
    metrics = [
        alerts.count_and_freshness(df, FACT),
        alerts.duplicate_metric(df, FACT),
        alerts.storage_metric(*sizes, FACT),
        alerts.failed_job_metric(runs, now),
    ]
    rules = alerts.rules_frame(spark, [odd, *alerts.ALERT_RULES])
    found = alerts.evaluate_rules(rules, metrics, now)
    assert [(r["name"], r["priority"]) for r in found.collect()] == [
        ("dag_failure_detected", 1),
        ("data_stagnation", 2),
        ("low_data_quality", 3),
        ("high_storage_usage", 4),
        ("odd", 5),
    ]
    assert found.first()["description"] == "Failed DAGs detected in the last 15 mins: a, b"
    summary = alerts.alert_summary(found).first()
    assert tuple(summary) == (5, 1, 1, 1, 1, True)
    assert alerts.classify(found).filter("place > 1").count() == 0
    assert tuple(alerts.alert_summary(found.limit(0)).first()) == (0, 0, 0, 0, 0, False)


def test_storage_without_history_is_quiet(spark):
    now, then = (spark.createDataFrame([(FACT, n)], "table_name string, bytes bigint") for n in (10, 0))
    metrics = [alerts.storage_metric(now, then, FACT)]
    assert alerts.evaluate_rules(alerts.rules_frame(spark), metrics, at("2024-01-01 00:00:00")).count() == 0


# feed


def lagged(spark, lags, parts=4):
    """Events of one window, some of them late by ``lags`` milliseconds."""
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(lags)], "i int, n bigint").repartition(parts)
    begin = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return rows.select(begin.alias("ts"), F.timestamp_millis(F.unix_millis(begin) + F.col("n")).alias("arrival"))


def test_lag_sketches_merge_in_any_order(spark):
    lags = [(i * 7919) % 20_011 for i in range(20_011)]  # each once
    whole = lagged(spark, lags)
    parts = [feed.lag_sketches(lagged(spark, lags[k::3]), "ts", "arrival") for k in range(3)]
    found = feed.merged_percentiles(parts[2].unionByName(parts[0]).unionByName(parts[1]))
    row = found.first()
    assert row.events == 20_011
    for name, share in feed.SHARES.items():
        assert abs(row[name] / 20_011 - share) <= feed.RANK_ERROR
    errors = feed.rank_errors(whole, "ts", "arrival", found).first()
    assert all(0 <= errors[name] <= feed.RANK_ERROR for name in feed.SHARES)
    wrong = found.withColumn("p50_ms", F.lit(15_000).cast("bigint"))
    assert feed.rank_errors(whole, "ts", "arrival", wrong).first()["p50_ms"] > 0.2
    # begun before the shuffle: no task gets a window's events
    plan = feed.lag_sketches(whole, "ts", "arrival")._jdf.queryExecution().executedPlan().toString()
    assert "partial_kll_sketch_agg_bigint" in plan


def test_small_windows_are_exact(spark):
    found = feed.merged_percentiles(feed.lag_sketches(lagged(spark, [5, 1, 3, 1, None]), "ts", "arrival")).first()
    assert (found.events, found.p50_ms, found.p99_ms) == (4, 1, 5)
    assert feed.lag_sketches(lagged(spark, [1]).limit(0), "ts", "arrival").collect() == []


# deliveries


def messages_frame(spark, n, start=0):
    text = spark.range(start, start + n).selectExpr("cast(id as string) k", "concat('v', id) v")
    return text.selectExpr(
        "cast(k as binary) key", "cast(v as binary) value",
        "array(named_struct('key', 'h', 'value', cast('x' as binary))) headers",
    )


def mirrored(spark, tmp_path, log):
    query = start_mirror(
        event_source(spark, "parquet", str(tmp_path / "from"), maxFilesPerTrigger="1"), "parquet",
        str(tmp_path / "state"), str(tmp_path / "to"), trigger={"availableNow": True},
    )
    query.awaitTermination()
    log.wait(query)
    return query


def test_mirror_keeps_keys_and_headers_and_its_counts_outlive_it(spark, tmp_path):
    log = delivery.DeliveryLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    try:
        messages_frame(spark, 7).repartition(3).write.parquet(str(tmp_path / "from"))
        mirrored(spark, tmp_path, log)
        messages_frame(spark, 5, 7).coalesce(1).write.mode("append").parquet(str(tmp_path / "from"))
        mirrored(spark, tmp_path, log)
        mirrored(spark, tmp_path, log)  # nothing new
    finally:
        spark.streams.removeListener(log)
    source = spark.read.parquet(str(tmp_path / "from"))
    copied = spark.read.parquet(str(tmp_path / "to"))
    assert rows(copied) == rows(source) and copied.columns == ["key", "value", "headers"]
    kept = delivery.read_deliveries(spark, str(tmp_path / "log"))
    totals = delivery.delivery_totals(kept).drop("query").first()
    size = sum(len(f"v{i}") for i in range(12))
    assert tuple(totals) == (4, 0, 12, 12, size, 0)
    running = delivery.running_totals(kept).orderBy("batch").collect()
    assert [r.batch for r in running] == [0, 1, 2, 3]
    assert [r.total for r in running][-2:] == [7, 12]
    assert sum(r.forwarded for r in running) == 12


def test_a_repeated_batch_is_counted_once_and_a_lost_one_is_missed(spark, tmp_path):
    log = delivery.DeliveryLog(spark, str(tmp_path / "log"))
    progress = {"id": "q", "name": None, "numInputRows": 4, "durationMs": {"addBatch": 1}}
    for batch in (0, 1, 1, 3):
        log.write({**progress, "batchId": batch})
    totals = delivery.delivery_totals(delivery.read_deliveries(spark, log.path)).first()
    assert (totals.batches, totals.missing_batches, totals.read_rows) == (3, 1, 12)


def test_offset_lag(spark, tmp_path):
    log = delivery.DeliveryLog(spark, str(tmp_path / "log"))
    sources = [
        {"latestOffset": '{"t": {"0": 10, "1": 7, "2": 5}, "s": {"0": 3}}', "endOffset": '{"t": {"0": 4, "1": 7}, "s": {"0": 3}}'},
        {"latestOffset": None, "endOffset": '{"logOffset": 3}'},
    ]
    log.write({"id": "q", "batchId": 2, "sources": sources})
    log.write({"id": "q", "batchId": 3, "sources": [{"endOffset": None}]})
    found = delivery.offset_lag(delivery.read_deliveries(spark, log.path))
    assert sorted(map(tuple, found.collect())) == [("q", 2, "s", 0), ("q", 2, "t", 11)]


def test_repeats_are_cut_within_the_span_and_none_is_too_late(spark, tmp_path):
    """Also over a restart. Null values and null keys are messages of their own."""
    schema = "key binary, value binary, headers array<struct<key:string,value:binary>>"

    def deliver(*pairs):
        rows = [(k and bytearray(k, "utf8"), None if v is None else bytearray(v, "utf8"), None) for k, v in pairs]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        source = event_source(spark, "parquet", str(tmp_path / "in"))
        query = (
            without_repeats(source, "1 hour").writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        query.awaitTermination()
        found = spark.read.parquet(str(tmp_path / "out")).selectExpr("string(key)", "string(value)")
        return sorted(map(tuple, found.collect()), key=str)

    assert deliver(("a", "1"), ("a", "1"), ("a", "2"), (None, "1"), ("a", None), ("a", None)) == sorted(
        [("a", "1"), ("a", "2"), (None, "1"), ("a", None)], key=str
    )
    assert len(deliver(("a", "1"), ("b", "1"), (None, "1"), ("a", ""))) == 6


# connectors


def test_kafka_options():
    options = kafka_options("b:9092", "views", "SASL_PLAINTEXT", "PLAIN", "jaas", startingOffsets="earliest")
    assert options["subscribe"] == "views" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false" and options["kafka.sasl.mechanism"] == "PLAIN"
    plain = kafka_options("b:9092", "views")
    assert plain["startingOffsets"] == "latest" and "kafka.sasl.jaas.config" not in plain


def test_jdbc_options():
    assert jdbc.postgres_url("h", 5432, "d") == "jdbc:postgresql://h:5432/d"
    options = jdbc.read_options("u", "t", "product_key", (1, 100), 8, user="me")
    assert options["partitionColumn"] == "product_key" and options["numPartitions"] == "8"
    assert jdbc.read_options("u", "t") == {"url": "u", "dbtable": "t"}
    with pytest.raises(ValueError):
        jdbc.read_options("u", "t", "k")


def test_table_ddl_creates_the_declared_tables(spark, tmp_path):
    for statement in table_ddl(str(tmp_path)):
        spark.sql(statement)
    try:
        for name, schema in STAR_TABLES.items():
            made = {f.name: f.dataType for f in spark.table(name).schema.fields}
            assert made == {f.name: f.dataType for f in schema.fields}
        spark.sql("INSERT INTO dim_store VALUES (1, 's', 'Store s')")
        analyze(spark, ["dim_store"])
        described = {r["col_name"]: r["data_type"] for r in spark.sql("DESCRIBE EXTENDED dim_store").collect()}
        assert "1 rows" in described["Statistics"]
    finally:
        for name in STAR_TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


# reports


def test_report_of_a_day_without_facts(spark):
    empty = spark.createDataFrame([], STAR_TABLES[FACT])
    today = dt.date(2024, 5, 1)
    assert reports.latest_report_date(empty, today).first()["max_date"] == today
    assert reports.latest_report_date(empty).first()["max_date"] is None
    products = spark.createDataFrame([], STAR_TABLES["dim_product"])
    assert reports.top_products(empty, products, today).count() == 0
    hourly = reports.product_hourly_views(empty, products, "p", today)
    assert reports.product_total_views(hourly).first()["total_views"] == 0


def test_ties_are_ranked_by_name(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), (None, 2)], "n string, view_count bigint")
    assert rows(reports._top(counts, "n", 3)) == [(1, "c", 3), (2, None, 2), (3, "a", 2)]


def test_a_failing_metric_costs_only_its_rules(spark):
    df = fact(spark)
    tables = {FACT: (df.limit(0), [alerts.row_count(), alerts.surplus("no_such_column")])}
    derived = [
        ("dag_failure", "run_log", lambda: alerts.failed_job_metric(df, at("2024-01-01 12:00:00"))),
        ("storage_check", FACT, lambda: alerts.storage_metric(*[spark.table("no_such_table")] * 2, FACT)),
    ]
    metrics, failures = alerts.measure(spark, tables, derived)
    rules = alerts.rules_frame(spark)
    assert rows(alerts.evaluate_rules(rules, [metrics], at("2024-01-01 00:00:00")), "name") == [("fact_table_empty",)]
    skipped = ["dag_failure_detected", "high_storage_usage", "low_data_quality"]
    assert rows(alerts.skipped_rules(rules, failures), "name") == [(n,) for n in skipped]


def test_an_error_while_running_is_raised(spark):
    broken = fact(spark, "2024-01-01 10:00:00").withColumn("time_stamp", F.raise_error(F.lit("lost")).cast("timestamp"))
    with pytest.raises(PySparkException, match="lost"):
        alerts.measure(spark, {FACT: (broken, [alerts.row_count(), alerts.freshness("time_stamp")])})


def test_all_metrics_of_a_table_in_one_scan(spark, monkeypatch):
    df = fact(spark, "2024-01-01 10:00:00").unionByName(fact(spark, "2024-01-01 11:00:00"))
    df = df.unionByName(df)
    measures = [alerts.row_count(), alerts.freshness("time_stamp"), alerts.surplus("fact_id")]
    runs, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda frame: runs.append(frame) or collect(frame))
    metrics, failures = alerts.measure(spark, {FACT: (df, measures)})
    monkeypatch.undo()
    assert len(runs) == 1 and failures.count() == 0
    found = {r.check_type: (r.value, str(r.latest)) for r in metrics.collect()}
    n = df.count()
    assert found["table_count"] == (n, "None")
    assert found["data_freshness"][1].startswith("2024-01-01 11:00")
    assert found["data_quality"][0] == n - df.select("fact_id").distinct().count()


# footprints


def test_growth_against_an_earlier_footprint(spark):
    when = lambda day: dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc)
    taken = [(when(1), "a", 1, 100, 10), (when(3), "a", 2, 300, 30), (when(9), "a", 9, 900, 90), (when(3), "b", 1, 5, 1)]
    history = spark.createDataFrame(taken, FOOTPRINTS)
    found = retention.storage_growth(history, at("2024-01-05 00:00:00"), at("2024-01-02 00:00:00"))
    # the newest up to each time; a table without an earlier size has no ratio
    assert sorted(map(tuple, found.select("table_name", "bytes", "then_bytes", "ratio").collect())) == [
        ("a", 300, 100, 3.0),
        ("b", 5, None, None),
    ]
    early = retention.storage_growth(history, at("2023-12-01 00:00:00"), at("2023-11-01 00:00:00"))
    assert early.count() == 0


def test_footprints_are_those_of_the_files(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    assert retention.footprints(house).count() == 0
    spark.range(10).selectExpr("id store_key", "string(id) store_id", "string(id) store_name").repartition(3).write.parquet(
        house.batch_path("dim_store", 0)
    )
    day = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    for _ in range(2):  # recorded again, it replaces what was there
        retention.record_footprint(house, day)
    kept = {r.table_name: r for r in retention.footprints(house).collect()}
    files = list((tmp_path / "house" / "dim_store").rglob("*.parquet"))
    assert (kept["dim_store"].files, kept["dim_store"].bytes) == (len(files), sum(f.stat().st_size for f in files))
    assert kept["dim_store"].rows == 10 and kept[FACT].bytes == 0 and len(kept) == len(STAR_TABLES)


def test_the_text_names_the_window(spark):
    runs = spark.createDataFrame([("a", "failed", "2024-01-01 09:00:00")], "job_id string, state string, e string")
    runs = runs.select("job_id", "state", F.col("e").cast("timestamp").alias("end_date"))
    now = at("2024-01-01 12:00:00")
    found = alerts.evaluate_rules(alerts.rules_frame(spark), [alerts.failed_job_metric(runs, now, minutes=240)], now)
    assert found.first()["description"] == "Failed DAGs detected in the last 240 mins: a"


def test_references_are_counted_in_one_pass(spark, tmp_path):
    names = list(FACT_REFERENCES)
    schema = "fact_id string, " + ", ".join(f"{n} bigint" for n in names)
    data = [("a", 1, 1, 1, 1, 1, 1), ("b", 1, 2, None, 1, 1, 1), (None, 7, 7, 7, 1, 1, 1), ("d", 7, 1, 1, 1, 1, None)]
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "fact"))
    member = lambda key: spark.createDataFrame([(1,), (2,)], f"{key} bigint")
    tables = {dim: member(key) for dim, key in FACT_REFERENCES.values()}
    tables = {FACT: spark.read.parquet(str(tmp_path / "fact")), **tables}
    for report in (quality.orphan_report(tables), quality.error_rate(tables)):
        plan = report._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Scan parquet") == 1
    found = {r[0]: tuple(r)[1:] for r in quality.orphan_report(tables).collect()}
    assert found["no_orphan_product"] == (4, 2, 1, 0) and found["no_orphan_store"] == (4, 1, 1, 0)
    assert found["no_orphan_location"] == (4, 1, 1, 1) and found["no_orphan_date"] == (4, 0, 0, 1)
    errors = {(r.table_name, r.check_name): (r.total_rows, r.error_rows) for r in quality.error_rate(tables).collect()}
    assert errors[FACT, "null_key"] == (4, 1) and errors[FACT, "missing_location"] == (4, 2)
    empty = {name: df.limit(0) for name, df in tables.items()}
    assert {tuple(r)[1:] for r in quality.orphan_report(empty).collect()} == {(0, 0, 0, 0)}


def test_a_file_of_the_mirror_feed_can_be_shared_by_tasks(spark, messages, tmp_path, monkeypatch):
    from pyarrow import parquet

    from starbrook.plans import catalog

    monkeypatch.setattr(catalog, "MIRROR_BLOCK_BYTES", 16 * 1024)
    sent = messages(*(f"{i} {i * 7919 % 10007} {'x' * (i % 50)}" for i in range(5000)))
    catalog._deliver(sent, 1, str(tmp_path / "from"))
    (file,) = (tmp_path / "from").glob("*.parquet")
    assert parquet.ParquetFile(file).num_row_groups > 1
    assert spark.read.parquet(str(tmp_path / "from")).count() == 5000
