import re
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import event, millis, rows
from __spark_entry__ import SMOKE_DIR
from starbrook.operators import kept_quality, quality, retention
from starbrook.plans import catalog
from starbrook.schemas import STAR_TABLES
from starbrook.sources import files
from starbrook.sources.events import event_source, parse_events
from starbrook.sources.ledger import FactLedger
from starbrook.sources.warehouse import FACT, Warehouse
from starbrook.streaming.ingest import Ingest

FACT_KEYS = ["product_key", "store_key", "location_key", "customer_key", "device_key", "date_id"]


def dims(warehouse):
    return {
        name: rows(df)
        for name, df in warehouse.tables().items()
        if name not in (FACT, "dim_product")
    } | {"dim_product": rows(warehouse.table("dim_product"), "product_key", "product_id")}


def content(warehouse):
    return {FACT: rows(warehouse.fact()), **dims(warehouse)}


def test_one_event_fills_the_star(ingest, warehouse, frame):
    ingest.load(frame(event()), 0)
    assert rows(warehouse.table("dim_store")) == [(1, "s1", "Store s1")]
    assert rows(warehouse.table("dim_product"), "product_key", "product_id") == [(1, "p1")]
    assert rows(warehouse.table("dim_customer")) == [(1, "cookie1", "a@mail.test", "u1")]
    device = warehouse.table("dim_device").first()
    assert (device["browser"], device["os"], device["resolution"]) == ("Chrome", "Windows", "1920x1080")
    place = warehouse.table("dim_location").first()
    assert (place["country_short"], place["city_name"]) == ("US", "San Jose")
    assert warehouse.table("dim_date").first()["date_id"] == 20240105
    fact = warehouse.fact().select("*", F.col("time_stamp").cast("string").alias("t")).first()
    assert [fact[k] for k in FACT_KEYS] == [1, 1, 1, 1, 1, 20240105]
    assert (fact["ip_address"], fact["t"]) == ("1.0.0.7", "2024-01-05 10:00:00")


def test_missing_attributes(ingest, warehouse, frame):
    names = ("product_id", "store_id", "device_id", "user_agent", "resolution", "ip", "email_address")
    ingest.load(frame(event(**dict.fromkeys(names)), event(id="e2", product_id="", store_id="")), 0)
    facts = warehouse.fact().filter(F.col("ip_address").isNull()).collect()
    assert [facts[0][k] for k in FACT_KEYS] == [None, None, None, 1, None, 20240105]
    assert rows(warehouse.table("dim_customer"))[0][1:3] == ("-1", "Not Defined")
    assert warehouse.table("dim_store").count() == 0


def test_blank_device_parts_match_the_dimension(ingest, warehouse, frame):
    ingest.load(frame(event(user_agent=None), event(id="e2", user_agent="", resolution=" ")), 0)
    assert warehouse.fact().filter(F.col("device_key").isNull()).count() == 0
    labels = rows(warehouse.table("dim_device"), "user_agent", "resolution", "browser")
    assert labels == [
        ("Not Defined", "1920x1080", "Unknown"),
        ("Not Defined", "Not Defined", "Unknown"),
    ]


def test_copies_inside_a_batch_collapse(ingest, warehouse, frame):
    ingest.load(frame(*[event()] * 5, event(id="e2", time_stamp=millis("2024-01-05T10:00:01"))), 0)
    assert warehouse.fact().count() == 2
    log = warehouse.run_log().filter("state = 'success'").first()
    assert (log["input_rows"], log["fact_rows"]) == (6, 2)


def test_seconds_milliseconds_zero_and_missing_time(ingest, warehouse, frame):
    stamps = [1704448800, 1704448800123, 0, None]
    ingest.load(frame(*(event(id=str(i), time_stamp=t) for i, t in enumerate(stamps))), 0)
    found = rows(warehouse.fact().select(F.col("time_stamp").cast("string"), "date_id"))
    assert found == [
        ("1970-01-01 00:00:00", 19700101),
        ("2024-01-05 10:00:00", 20240105),
        ("2024-01-05 10:00:00.123", 20240105),
        (None, None),
    ]
    assert rows(warehouse.table("dim_date"), "date_id") == [(19700101,), (20240105,)]
    ingest.load(frame(event(id="9", time_stamp=None)), 1)
    assert warehouse.fact().count() == 4


def test_later_batches_keep_keys_and_insert_only_new_facts(ingest, warehouse, frame):
    ingest.load(frame(event(product_id="m"), event(id="e2", product_id="z")), 0)
    ingest.load(
        frame(
            event(product_id="m"),
            event(id="e3", product_id="a"),
            event(id="e4", product_id="n", time_stamp=millis("2023-12-31T23:59:59")),
        ),
        1,
    )
    keys = rows(warehouse.table("dim_product"), "product_id", "product_key")
    assert keys == [("a", 3), ("m", 1), ("n", 4), ("z", 2)]
    assert warehouse.fact().count() == 4
    assert sorted(warehouse.days()) == [20231231, 20240105]


def test_repeating_a_batch_changes_nothing(ingest, warehouse, frame):
    first = frame(event(), event(id="e2", product_id="p2"))
    second = frame(event(id="e3", product_id="p3", email_address="new@mail.test",
                         time_stamp=millis("2024-01-06T00:00:00")), event())
    ingest.load(first, 0)
    ingest.load(second, 1)
    before = content(warehouse)
    ingest.load(second, 1)
    assert content(warehouse) == before
    assert len(before[FACT]) == 3


def test_customer_attributes_follow_event_time(ingest, warehouse, frame):
    def customer():
        return rows(warehouse.table("dim_customer"), "customer_id", "email_address", "user_id_db")

    noon, later = millis("2024-01-05T12:00:00"), millis("2024-01-05T13:00:00")
    ingest.load(
        frame(
            event(id="2", time_stamp=noon, email_address="noon@x", user_id_db=None),
            event(id="1", time_stamp=noon - 1, email_address="early@x", user_id_db="u7"),
        ),
        0,
    )
    assert customer() == [("cookie1", "noon@x", "u7")]
    ingest.load(frame(event(id="3", time_stamp=noon - 1000, email_address="old@x", user_id_db="")), 1)
    assert customer() == [("cookie1", "noon@x", "u7")]
    ingest.load(frame(event(id="4", time_stamp=later, email_address=" ", user_id_db="u8")), 2)
    assert customer() == [("cookie1", "noon@x", "u8")]
    ingest.load(frame(event(id="5", time_stamp=later, email_address="late@x", user_id_db=None)), 3)
    assert customer() == [("cookie1", "late@x", "u8")]
    assert warehouse.table("dim_customer").first()["customer_key"] == 1


def test_a_failed_batch_is_invisible_and_can_be_repeated(ingest, warehouse, frame, monkeypatch):
    ingest.load(frame(event()), 0)
    before = content(warehouse)
    bad = frame(event(id="e2", product_id="p2", device_id="c2"))

    def fail(facts, batch_id):
        raise RuntimeError("disk full")

    monkeypatch.setattr(warehouse, "write_facts", fail)
    with pytest.raises(RuntimeError):
        ingest.load(bad, 1)
    assert content(warehouse) == before
    failed = warehouse.run_log().filter("state = 'failed'").collect()
    assert [(r["run_id"], r["error"]) for r in failed] == [(1, "disk full")]
    monkeypatch.undo()
    ingest.load(frame(event(id="e9", product_id="p9")), 2)
    skipped = rows(warehouse.table("dim_product"), "product_id", "product_key")
    assert skipped == [("p1", 1), ("p9", 2)]
    ingest.load(bad, 1)


def test_large_lookups_give_the_same_star(spark, ranges, frame, tmp_path, monkeypatch):
    events = [
        event(id=str(i), product_id=f"p{i % 7}" if i % 3 else "hot", device_id=f"c{i % 11}" if i % 4 else None,
              ip=f"1.0.{i % 3}.{i % 250}", time_stamp=millis("2024-01-05T00:00:00") + i * 60_000)
        for i in range(200)
    ]
    usual = Warehouse(spark, str(tmp_path / "usual"))
    shuffled = Warehouse(spark, str(tmp_path / "shuffled"))
    for warehouse, limit in ((usual, None), (shuffled, 0)):
        if limit is not None:
            monkeypatch.setattr("starbrook.streaming.ingest.BROADCAST_BYTES", limit)
            monkeypatch.setattr("starbrook.operators.lookup.LEAST_HOT_ROWS", 20)
        ingest = Ingest(warehouse, ranges)
        ingest.load(frame(*events[:120]), 0)
        ingest.load(frame(*events[80:]), 1)
    assert content(shuffled) == content(usual)


def test_many_touched_days_use_one_span(ingest, warehouse, frame, monkeypatch):
    monkeypatch.setattr("starbrook.operators.facts.MAX_DAY_PREDICATES", 2)
    days = [event(id=str(d), time_stamp=millis(f"2024-01-{d:02}T10:00:00")) for d in range(1, 8)]
    ingest.load(frame(*days), 0)
    ingest.load(frame(*days, event(id="n", time_stamp=millis("2024-01-03T11:00:00"))), 1)
    assert warehouse.fact().count() == 8


# streaming


def stream_once(ingest, spark, folder):
    source = event_source(spark, "parquet", f"{folder}/inbox")
    query = ingest.start(source, f"{folder}/state", trigger={"availableNow": True})
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_survives_restart(spark, ranges, messages, tmp_path):
    first = [event(), event(id="e2", product_id="p2"), "garbage", event()]
    second = [event(), event(id="e3", product_id="p0", time_stamp=millis("2024-01-01T00:00:00"))]
    streamed = Warehouse(spark, str(tmp_path / "streamed"))
    for values in (first, second):
        messages(*values).write.mode("append").parquet(str(tmp_path / "inbox"))
        stream_once(Ingest(streamed, ranges), spark, str(tmp_path))
    stream_once(Ingest(streamed, ranges), spark, str(tmp_path))  # nothing new

    batch = Warehouse(spark, str(tmp_path / "batch"))
    for number, values in enumerate((first, second)):
        Ingest(batch, ranges).load(parse_events(messages(*values)), number)
    assert content(streamed) == content(batch)
    assert rows(streamed.rejects()) == [("garbage", "malformed_json")]
    done = streamed.run_log().filter("state = 'success'")
    assert rows(done, "run_id", "input_rows", "rejected_rows", "fact_rows") == [(0, 4, 1, 2), (1, 2, 0, 1)]


def test_empty_batch_is_skipped(ingest, warehouse, messages):
    ingest.process_batch(messages().limit(0), 0)
    assert warehouse.run_log().count() == 0
    assert warehouse.snapshot().empty


def test_text_files_are_a_source(spark, ingest, warehouse, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"id": "1", "product_id": "p", "time_stamp": 1704448800}\n')
    source = event_source(spark, "text", str(tmp_path / "in"))
    ingest.start(source, str(tmp_path / "state"), {"availableNow": True}).awaitTermination()
    assert rows(warehouse.table("dim_product"), "product_id") == [("p",)]


# retention and compaction


@pytest.fixture(scope="module")
def template(spark, ranges, frame_of, tmp_path_factory):
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("template") / "warehouse"))
    for number, day in enumerate((1, 2, 3, 3)):
        events = [
            event(id=f"{number}-{h}", product_id=f"p{number}", email_address=f"{number}@x",
                  time_stamp=millis(f"2024-01-{day:02}T{h:02}:00:00"))
            for h in (0, 6, 12, 18)
        ]
        Ingest(warehouse, ranges).load(frame_of(*events), number)
    return warehouse


@pytest.fixture()
def loaded(spark, template, tmp_path):
    shutil.copytree(template.root, tmp_path / "loaded")
    return Warehouse(spark, str(tmp_path / "loaded"))


def test_archive_moves_old_facts(spark, loaded):
    everything = rows(loaded.fact())
    as_of = F.lit("2024-02-02 12:00:00").cast("timestamp")
    found = retention.archival_candidates(loaded.fact(), as_of).first()
    assert (found["total_records"], found["archival_candidates"], found["has_candidates"]) == (16, 12, True)
    assert retention.archive_old_facts(loaded, as_of) == 12
    assert loaded.days() == [20240103]
    assert loaded.fact().agg(F.min("time_stamp").cast("string")).first()[0] == "2024-01-03 12:00:00"
    archived = retention.read_archive(loaded).select(*loaded.fact().columns)
    assert rows(loaded.fact().unionByName(archived)) == everything
    assert retention.archive_old_facts(loaded, as_of) == 0
    later = F.lit("2024-02-02 18:00:00").cast("timestamp")
    assert retention.archive_old_facts(loaded, later) == 2
    assert retention.read_archive(loaded).count() == 14


def test_an_interrupted_archive_run_can_be_repeated(loaded, monkeypatch):
    as_of = F.lit("2024-02-02 12:00:00").cast("timestamp")

    def crash(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(retention.files, "delete", crash)
    with pytest.raises(RuntimeError):
        retention.archive_old_facts(loaded, as_of)
    monkeypatch.undo()
    assert loaded.fact().count() == 16
    assert retention.archive_old_facts(loaded, as_of) == 12
    assert (loaded.fact().count(), retention.read_archive(loaded).count()) == (4, 12)


def test_late_events_of_archived_days_go_to_the_archive(loaded, ranges, frame):
    as_of = F.lit("2024-02-02 12:00:00").cast("timestamp")
    retention.archive_old_facts(loaded, as_of)
    ingest = Ingest(loaded, ranges, archive_before=retention.cutoff(as_of))
    old = millis("2024-01-01T06:00:00")
    again = event(id="0-6", product_id="p0", time_stamp=old)
    late = event(id="late", product_id="p1", time_stamp=old + 5)
    ingest.load(frame(again, late, event(id="now", time_stamp=millis("2024-01-09T00:00:00"))), 4)
    assert loaded.fact().count() == 5
    assert retention.read_archive(loaded).count() == 13


def test_compaction_keeps_the_content(spark, loaded, ranges, frame):
    before = content(loaded)
    retention.compact_fact_days(loaded, loaded.days())
    for table in ("dim_customer", "dim_product", "dim_store", "dim_location", "dim_device", "dim_date"):
        retention.compact_dimension(loaded, table)
        assert len(files.folders(spark, loaded.path(table))) == 1
    assert content(loaded) == before
    assert files.folders(spark, f"{loaded.path(FACT)}/date_id=20240103") == ["batch_id=3"]
    Ingest(loaded, ranges).load(frame(event(id="x", product_id="p9"), event(id="3-0", product_id="p3", time_stamp=millis("2024-01-03T00:00:00"))), 4)
    assert loaded.fact().count() == 17
    assert (5, "p9") in rows(loaded.table("dim_product"), "product_key", "product_id")


@pytest.mark.parametrize("table", ["dim_customer", FACT])
@pytest.mark.parametrize("step", ["copy", "list", "delete", "half"])
def test_an_interrupted_rewrite_is_completed(spark, loaded, ranges, frame, monkeypatch, table, step):
    before, deleted = content(loaded), []

    def crash(*args):
        raise RuntimeError("lost")

    def crash_later(spark, path):
        # the first deletion makes room, the second follows the new rows
        deleted.append(path)
        if len(deleted) == {"delete": 2, "half": 3}[step]:
            crash()
        delete(spark, path)

    delete, folders = files.delete, files.folders
    if step == "copy":  # counted, not listed
        monkeypatch.setattr(files, "folders", lambda spark, path: crash() if "/rows" in path else folders(spark, path))
    elif step == "list":  # listed, nothing applied
        monkeypatch.setattr(type(loaded), "_apply_rewrite", crash)
    else:
        monkeypatch.setattr(files, "delete", crash_later)
    with pytest.raises(RuntimeError):
        if table == FACT:
            retention.compact_fact_days(loaded, loaded.days())
        else:
            retention.compact_dimension(loaded, table)
    monkeypatch.undo()
    ingest = Ingest(loaded, ranges)
    assert content(loaded) == before
    staged = [n for n in files.folders(spark, f"{loaded.root}/_staging") if n.startswith("rewrite-")]
    assert staged == ([f"rewrite-{table}"] if step == "copy" else [])
    # a copy that was never listed does not come back, and does not stand in the way
    ingest.load(frame(event(id="x", product_id="p9", time_stamp=millis("2024-01-03T09:00:00"))), 4)
    retention.compact_fact_days(loaded, loaded.days())
    retention.compact_dimension(loaded, "dim_customer")
    assert loaded.fact().count() == 17
    assert files.folders(spark, f"{loaded.path(FACT)}/date_id=20240103") == ["batch_id=4"]


def test_batches_after_an_interrupted_rewrite_stay(loaded, ranges, frame, monkeypatch):
    ingest = Ingest(loaded, ranges)

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(type(loaded), "_apply_rewrite", crash)
        with pytest.raises(RuntimeError):
            retention.compact_fact_days(loaded, loaded.days())
    # this writer started before the rewrite, so it does not complete it
    ingest.load(frame(event(id="x", product_id="p9", time_stamp=millis("2024-01-03T09:00:00"))), 4)
    Ingest(loaded, ranges)
    assert loaded.fact().count() == 17


def test_footprint(loaded):
    found = retention.table_footprint({t: loaded.stored(t) for t in (FACT, "dim_store")})
    by_name = {r["table_name"]: r for r in found.collect()}
    assert by_name[FACT]["rows"] == 16 and by_name[FACT]["files"] >= 4
    assert by_name["dim_store"]["rows"] == 1 and by_name["dim_store"]["bytes"] > 0
    report = retention.archival_report(
        retention.archival_candidates(loaded.fact(), F.current_timestamp()), found
    )
    assert report.count() == 9


# plans


def test_reports_read_one_day_folder(loaded):
    day = loaded.fact().filter(F.col("date_id") == 20240102)
    text = day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*\(date_id#\d+ = 20240102\)", text)
    only = loaded.fact([20240102])
    assert {"20240102" in f for f in only.inputFiles()} == {True}


def test_files_have_the_declared_types(loaded):
    from starbrook.operators.quality import schema_check

    snapshot = loaded.snapshot()
    found = schema_check({t: loaded.as_written(t, snapshot) for t in STAR_TABLES})
    assert rows(found.filter("status <> 'ok'")) == []


def test_ingest_runs_no_python_on_rows(ingest, ranges, frame):
    from starbrook.operators.facts import prepare_events

    text = prepare_events(frame(event()), ranges)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text.replace("Scan ExistingRDD", "")
    assert "NestedLoop" not in text


def test_replay_after_compaction_changes_nothing(spark, loaded, ranges, frame):
    """A stop between the log row and the checkpoint makes a stream deliver its newest batch again."""
    before = content(loaded)
    retention.compact_fact_days(loaded, loaded.days())
    for table in ("dim_customer", "dim_product", "dim_date"):
        retention.compact_dimension(loaded, table)
    Ingest(loaded, ranges).load(frame(event(id="3-0", product_id="p3", time_stamp=millis("2024-01-03T00:00:00"))), 3)
    assert content(loaded) == before


def test_a_new_checkpoint_adds_to_the_history(spark, ranges, messages, tmp_path):
    """Two streams over one warehouse both begin with batch 0; neither replaces the other's."""
    warehouse = Warehouse(spark, str(tmp_path / "warehouse"))
    days = ("2024-01-05", "2024-01-06")
    for number, day in enumerate(days):
        inbox = str(tmp_path / f"inbox{number}")
        values = (event(id=f"{number}-{i}", device_id=f"c{number}", product_id=f"p{i}", time_stamp=millis(f"{day}T10:00:00")) for i in range(2))
        messages(*values).write.parquet(inbox)
        source = event_source(spark, "parquet", inbox)
        Ingest(warehouse, ranges).start(source, str(tmp_path / f"state{number}"), trigger={"availableNow": True}).awaitTermination()
    assert warehouse.fact().count() == 4
    assert rows(warehouse.table("dim_customer"), "customer_id", "customer_key") == [("c0", 1), ("c1", 2)]
    log = warehouse.run_log().filter("state = 'success'")
    assert rows(log, "run_id", "attempt") == [(0, 0), (0, 1)] and log.select("feed").distinct().count() == 2


def test_a_repeat_with_fewer_days_leaves_the_batch(ingest, warehouse, frame):
    both = frame(event(time_stamp=millis("2024-01-05T10:00:00")), event(id="2", product_id="p2", time_stamp=millis("2024-01-06T10:00:00")))
    ingest.load(both, 0)
    before = content(warehouse)
    ingest.load(frame(event(time_stamp=millis("2024-01-05T10:00:00"))), 0)
    assert content(warehouse) == before and warehouse.days() == [20240105, 20240106]


def test_attempts_that_broke_off_never_show(ingest, warehouse, frame, monkeypatch):
    for number in range(2):  # the first batch fails twice, by writers that stop
        with monkeypatch.context() as patched:
            patched.setattr(warehouse, "write_facts", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                ingest.load(frame(event(device_id=f"gone{number}")), 0)
    ingest.load(frame(event()), 0)
    assert rows(warehouse.table("dim_customer"), "customer_id", "customer_key") == [("cookie1", 1)]
    assert warehouse.snapshot().unfinished == (0, 1) and warehouse.fact().count() == 1


def deliveries(warehouse, ranges, frame, **options):
    """Three batches, the second changing a customer, and the last once more by a new writer."""
    batches = [
        frame(event(), event(id="e2", product_id="p2", store_id=None, email_address=None)),
        frame(event(id="e3", email_address="b@mail.test", time_stamp=millis("2024-01-06T10:00:00")), event()),
        frame(event(id="e4", device_id="cookie2", referrer_url=None, time_stamp=None), event(id="e5", product_id="p3")),
    ]
    for number, batch in [*enumerate(batches), (2, batches[2])]:
        made = {k: v() for k, v in options.items()}
        Ingest(warehouse, ranges, **made).load(batch, number)


def test_kept_counts_equal_a_full_scan(warehouse, ranges, frame):
    deliveries(warehouse, ranges, frame, keep_quality=lambda: True)
    kept, tables = warehouse.quality_counts(), warehouse.tables()
    full = quality.completeness(tables)
    assert rows(kept_quality.completeness(kept), *full.columns) == rows(full)
    tables["dim_product"] = tables["dim_product"].filter("product_id <> 'p2'")
    counted = quality.error_rate(tables, 2)
    found = kept_quality.error_rate(kept, tables, 2)
    dims = "table_name <> 'dim_product'"  # its members were taken away here, not by a batch
    assert rows(found.filter(dims), *counted.columns) == rows(counted.filter(dims))
    by_day = {r["date_id"]: r["total_rows"] for r in kept_quality.completeness_by_day(kept).collect()}
    assert by_day == {r[0]: r[1] for r in tables[FACT].groupBy("date_id").count().collect()} and None in by_day
    plan = kept_quality.completeness(kept)._jdf.queryExecution().executedPlan().toString()
    assert FACT + "/" not in plan and plan.count("FileScan") == 1


def test_kept_counts_of_a_failed_batch_do_not_count(warehouse, ranges, frame, monkeypatch):
    ingest = Ingest(warehouse, ranges, keep_quality=True)
    ingest.load(frame(event()), 0)
    with monkeypatch.context() as broken:
        broken.setattr(kept_quality, "key_counts", lambda fact: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest.load(frame(event(id="e2", product_id="p2")), 1)
    Ingest(warehouse, ranges, keep_quality=True).load(frame(event(id="e2", product_id="p2")), 1)
    full = quality.completeness(warehouse.tables())
    assert rows(kept_quality.completeness(warehouse.quality_counts()), *full.columns) == rows(full)
    assert warehouse.fact().count() == 2


def test_the_ledger_gives_the_same_facts(spark, warehouse, ranges, frame, tmp_path):
    def ledger():
        # as after a restart, when the catalog does not know the table
        spark.sql("DROP TABLE IF EXISTS ids_of_facts")
        return FactLedger(spark, "ids_of_facts", f"{tmp_path}/ledger", 4)

    plain = Warehouse(spark, f"{tmp_path}/plain")
    deliveries(plain, ranges, frame)
    deliveries(warehouse, ranges, frame, ledger=ledger)
    assert rows(warehouse.fact()) == rows(plain.fact())
    opened = ledger()
    assert rows(opened.rows(), "fact_id") == rows(plain.fact(), "fact_id")
    assert opened.rows([20240106]).count() == 1 and opened.rows([None, 20240106]).count() == 2
    assert opened.rows([]).count() == 0


def test_the_ledger_moves_only_the_batch(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS ids_moved")
    ledger = FactLedger(spark, "ids_moved", f"{tmp_path}/ledger", 8)
    ids = spark.range(2000).selectExpr("concat('f', id) as fact_id", "20240101 + int(id % 3) as date_id")
    ledger.append(ids.filter("fact_id < 'f5'"), 0)
    ledger.append(ids.filter("fact_id >= 'f5' and fact_id < 'f7'"), 1)
    new = ledger.absent(ids, F.col("batch_id") <= 1)
    assert rows(new, "fact_id") == rows(ids.filter("fact_id >= 'f7'"), "fact_id")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    # of an attempt that did not succeed nothing counts
    assert ledger.absent(ids, F.col("batch_id") < 1).count() == ids.filter("fact_id >= 'f5'").count()
    one_day = ledger.rows([20240102])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_id" in one_day


def test_a_delivery_is_shared_by_tasks_however_its_file_is_laid_out(spark, monkeypatch):
    taken = []

    class Taken:
        def __init__(self, *args, **kwargs):
            pass

        def load(self, events, number):
            taken.append([n for _, n in rows(events.groupBy(F.spark_partition_id()).count())])

    monkeypatch.setattr(catalog, "Ingest", Taken)
    monkeypatch.setattr(catalog.retention, "record_footprint", lambda *args: None)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "4"}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        catalog._load_once(spark, SMOKE_DIR)
        catalog._load_slices(spark, SMOKE_DIR)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(taken) == 4
    for sizes in taken:  # the file is one row group
        assert len(sizes) == 4 and max(sizes) < sum(sizes) / 2


def test_a_large_batch_is_moved_once_by_fact_id(spark, warehouse, ranges, frame, monkeypatch):
    """The shuffle that combines copies also serves the comparison with earlier facts."""
    monkeypatch.setattr("starbrook.streaming.ingest.BROADCAST_BYTES", 0)
    monkeypatch.setattr("starbrook.operators.lookup.LEAST_HOT_ROWS", 20)
    staged, written = [], []
    stage, write = Ingest._stage, Warehouse.write_facts

    def staging(self, df, attempt, name):
        staged.append(name)
        return stage(self, df, attempt, name)

    def writing(self, facts, attempt):
        written.append(facts._jdf.queryExecution().executedPlan().toString())
        return write(self, facts, attempt)

    monkeypatch.setattr(Ingest, "_stage", staging)
    monkeypatch.setattr(Warehouse, "write_facts", writing)
    ingest, threshold = Ingest(warehouse, ranges), "spark.sql.autoBroadcastJoinThreshold"
    first = [event(id=str(i), product_id=f"p{i}") for i in range(9)]
    usual = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        ingest.load(frame(*first, event(id="0", product_id="p0")), 0)
        ingest.load(frame(*first[5:], event(id="new", product_id="p9"), event(id="new", product_id="p9")), 1)
    finally:
        spark.conf.set(threshold, usual)
    assert "facts" not in staged
    by_id = [line for line in written[1].splitlines() if re.search(r"Exchange hashpartitioning\(fact_id#\d+, ", line)]
    assert len(by_id) == 2  # the batch and the earlier facts, once each
    assert sorted(r["fact_rows"] for r in warehouse.run_log().filter("state = 'success'").collect()) == [1, 9]


def test_suppression_keeps_its_state_on_disk(spark, ingest, messages, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    messages(event(), event(), event(id="e2", product_id="p2")).write.parquet(f"{tmp_path}/inbox")
    source = event_source(spark, "parquet", f"{tmp_path}/inbox")
    query = ingest.start(source, f"{tmp_path}/state", trigger={"availableNow": True}, suppress_within="1 hour")
    query.awaitTermination()
    metrics = query.lastProgress["stateOperators"][0]["customMetrics"]
    assert any(name.startswith("rocksdb") for name in metrics)
    assert ingest.warehouse.fact().count() == 2
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before  # other queries keep theirs
