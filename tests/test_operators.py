import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from starbrook.operators import lookup as L
from starbrook.operators.locate import locate, overlapping_ranges
from starbrook.operators.numbering import number_rows
from starbrook.schemas import IP_RANGE_SCHEMA
from starbrook.sources.events import parse_events
from starbrook.sources.ip_ranges import read_ip_ranges


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# numbering


@pytest.mark.parametrize("size", [0, 1, 7, 5000])
def test_number_rows_follows_the_order(spark, size):
    names = [f"k{i}" for i in range(size)]
    random.Random(size).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    found = {r["name"]: r["n"] for r in number_rows(df, [F.col("name")], "n", 100).collect()}
    assert found == {name: 101 + i for i, name in enumerate(sorted(names))}


def test_number_rows_sorts_in_many_tasks(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("k")).repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        numbered = number_rows(df, [F.col("k").desc()], "n")
        parts = numbered.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
        best = numbered.agg(F.max(F.struct("k", "n")).alias("m"), F.countDistinct("n").alias("d"))
        row = best.first()
        assert (row["m"]["n"], row["d"]) == (1, 100_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


# lookups


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third have none."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    )
    return spark.range(0, 30_000, 1, 6).select("id", key.alias("key"))


def test_attach_gives_the_same_rows_on_every_path(spark, skewed, monkeypatch):
    monkeypatch.setattr(L, "LEAST_HOT_ROWS", 1000)
    keys = skewed.select("key").dropna().distinct().filter(F.col("key") != "k5")
    table = keys.withColumn("value", F.xxhash64("key"))
    expected = rows(skewed.join(table, "key", "left").select("id", "key", "value"))
    for small in (None, True, False):
        found = L.attach(skewed, table, "key", ["value"], small).select("id", "key", "value")
        assert rows(found) == expected


def test_hot_and_missing_keys_are_spread(spark, skewed, monkeypatch):
    """In the shuffled join no partition may hold much more than its share."""
    monkeypatch.setattr(L, "LEAST_HOT_ROWS", 1000)
    table = skewed.select("key").dropna().distinct().withColumn("value", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        joined = L.attach(skewed, table, "key", ["value"], small=False)
        plain = skewed.join(table, "key", "left")

        def largest(df):
            sizes = df.groupBy(F.spark_partition_id()).agg(F.count("id").alias("n"), F.sum("value"))
            return max(r["n"] for r in sizes.collect())

        assert largest(plain) >= 10_000
        assert largest(joined) < 10_000
        assert joined.filter(F.col("key").isNotNull() & F.col("value").isNull()).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_hot_keys_are_few_and_complete(skewed, monkeypatch):
    assert L.hot_keys(skewed, "key").count() == 0
    monkeypatch.setattr(L, "LEAST_HOT_ROWS", 9_999)
    assert [r["key"] for r in L.hot_keys(skewed, "key").collect()] == ["hot"]
    monkeypatch.setattr(L, "LEAST_HOT_ROWS", 0)
    monkeypatch.setattr(L, "MOST_HOT_KEYS", 10)
    assert [r["key"] for r in L.hot_keys(skewed, "key").collect()] == ["hot"]


def test_measured_bytes_decides_about_broadcast(spark):
    df = spark.createDataFrame([("x" * 100,), (None,)], "t string")
    size = L.measured_bytes(df)
    assert size == 100 + 2 * (8 + L.ROW_OVERHEAD)
    assert L.fits_broadcast(df, size) and not L.fits_broadcast(df, size - 1)
    assert L.measured_bytes(df.limit(0)) == 0


@pytest.mark.parametrize("small", [True, False])
def test_known_and_missing_members(spark, small):
    members = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    table = spark.createDataFrame([("b", 1), ("x", 2)], "id string, key int")
    known = L.known_members(members, table, "id", small)
    assert rows(known) == [("b", 1)]
    assert rows(L.missing_members(members, known, "id", small)) == [("a",), ("c",)]


@pytest.mark.parametrize("small", [True, False])
def test_keys_of_all_dimensions_by_one_join(spark, small):
    events = spark.createDataFrame(
        [("p1", "s1", "c1"), ("p1", None, "c2"), ("p9", "s2", "p1"), (None, None, None)] * 5,
        "product string, store string, customer string",
    )
    names = {"dim_product": "product", "dim_store": "store", "dim_customer": "customer"}
    tables = {
        "dim_product": spark.createDataFrame([("p1", 1), ("p2", 2)], "id string, k bigint"),
        "dim_store": spark.createDataFrame([("s1", 7), ("s3", 8)], "id string, k bigint"),
        # two versions of one member, and an id that another dimension has, too
        "dim_customer": spark.createDataFrame([("c1", 4), ("c1", 4), ("p1", 5)], "id string, k bigint"),
    }
    keys = L.batch_keys(events, names)
    assert keys.agg(F.sum("events")).first()[0] == 40
    found = L.resolve_keys(keys, tables, small)
    assert rows(found) == [
        ("dim_customer", "c1", 5, 4),
        ("dim_customer", "p1", 5, 5),
        ("dim_product", "p1", 10, 1),
        ("dim_store", "s1", 5, 7),
    ]


def test_keys_are_shuffled_once_whatever_the_number_of_dimensions(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n in (2, 5):
            columns = [f"c{i}" for i in range(n)]
            events = spark.createDataFrame([("a",) * n], ", ".join(f"{c} string" for c in columns))
            tables = {c: spark.createDataFrame([("a", 1)], "id string, k bigint") for c in columns}
            found = L.resolve_keys(L.batch_keys(events, {c: c for c in columns}), tables, False)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") == 2  # the batch's keys, and all members
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


# locations


@pytest.mark.parametrize("small", [True, False])
def test_locate(spark, ranges, small):
    ips = {
        "1.0.0.0": "San Jose",
        "1.0.0.255": "San Jose",
        "1.0.1.0": "Hanoi",
        "1.0.255.255": "Hanoi",
        "1.1.0.0": None,
        "2.0.0.0": "Paris",
        "2.255.255.255": "Paris",
        "3.0.0.0": None,
        "256.1.1.1": None,
        "not-an-ip": None,
        "::1": None,
    }
    df = spark.createDataFrame([(ip,) for ip in [*ips, None, "1.0.0.0"]], "ip string")
    found = locate(df, ranges, ranges_small=small)
    assert found.count() == len(ips) + 2
    got = {r["ip"]: r["loc_info"] and r["loc_info"]["city_name"] for r in found.collect()}
    assert got == {**ips, None: None}


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10**6))
def test_locate_agrees_with_brute_force(spark, seed):
    rng = random.Random(seed)
    edges = sorted(rng.sample(range(1 << 32), 40) + [0, 65535, 65536, (1 << 32) - 1])
    spans = [(a, b - 1) for a, b in zip(edges, edges[1:]) if rng.random() < 0.7 and b > a]
    table = spark.createDataFrame(
        [(a, b, f"C{i}", f"c{i}", None, f"t{i}") for i, (a, b) in enumerate(spans)], IP_RANGE_SCHEMA
    )
    addresses = [rng.randrange(1 << 32) for _ in range(60)] + edges
    texts = [".".join(str(a >> s & 255) for s in (24, 16, 8, 0)) for a in addresses]
    df = spark.createDataFrame(list(zip(addresses, texts)), "a bigint, ip string")
    expected = {
        a: next((f"t{i}" for i, (lo, hi) in enumerate(spans) if lo <= a <= hi), None)
        for a in addresses
    }
    for small in (True, False):
        found = locate(df, table, ranges_small=small).collect()
        assert {r["a"]: r["loc_info"] and r["loc_info"]["city_name"] for r in found} == expected


def test_locate_uses_no_nested_loop_and_no_python(spark, ranges):
    df = spark.createDataFrame([("1.0.0.1",)], "ip string")
    for small in (True, False):
        text = plan(locate(df, ranges, ranges_small=small))
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "PythonUDF" not in text and "EvalPython" not in text
    assert "Exchange hash" not in plan(locate(df, ranges, ranges_small=True))


def test_overlapping_ranges_are_reported(spark, ranges):
    assert overlapping_ranges(ranges).count() == 0
    extra = spark.createDataFrame([(16777300, 16777310, "X", "x", "x", "x")], IP_RANGE_SCHEMA)
    assert overlapping_ranges(ranges.unionByName(extra)).count() == 1


# parsing


def test_parse_events(messages):
    good = {
        "id": "1",
        "time_stamp": 1704448800,
        "option": [{"option_id": "color", "option_label": None}, {"option_id": "size"}],
        "extra": "ignored",
    }
    df = parse_events(
        messages(
            good,
            "garbage",
            {"id": "2", "time_stamp": "x"},
            {},
            None,
            "",
            {"id": "3", "time_stamp": 9223372036854775807},
            {"id": "4"},
        )
    )
    found = df.collect()
    assert [r["reject_reason"] for r in found] == [
        None, "malformed_json", None, "empty_event", "null_value", "empty_event",
        "time_out_of_range", None,
    ]
    assert found[0]["option"][0]["option_label"] is None and found[0]["option"][1]["option_id"] == "size"
    assert found[0]["time_stamp"] == 1704448800 and found[0]["raw_value"] is None
    assert (found[2]["id"], found[2]["time_stamp"]) == ("2", None)
    assert found[1]["raw_value"] == "garbage"
    assert (found[7]["id"], found[7]["product_id"]) == ("4", None)


def test_overlapping_ranges_are_refused(spark, ranges, tmp_path):
    ranges.write.parquet(str(tmp_path / "good"))
    assert read_ip_ranges(spark, str(tmp_path / "good")).count() == ranges.count()
    nested = spark.createDataFrame([(33554500, 33554600, "X", "x", "x", "x")], IP_RANGE_SCHEMA)
    ranges.unionByName(nested).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="overlap"):
        read_ip_ranges(spark, str(tmp_path / "bad"))
