import datetime as dt
import hashlib
import ipaddress

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import CHROME
from starbrook.functions import geo, useragent
from starbrook.functions import scalars as S

IPHONE = (
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 "
    "(KHTML, like Gecko) Version/14.1.1 Mobile/15E148 Safari/604.1"
)


def one(spark, column, **inputs):
    types = {int: "bigint", str: "string", type(None): "string"}
    row = spark.range(1).select(
        *(F.lit(v).cast(types[type(v)]).alias(n) for n, v in inputs.items())
    )
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("store, name", [("123", "Store 123"), ("A", "Store A")])
def test_store_name(spark, store, name):
    assert one(spark, S.store_name(F.col("s")), s=store) == name


@pytest.mark.parametrize(
    "cookie, expected", [("cust_1", "cust_1"), ("", "-1"), (None, "-1"), ("  ", "  ")]
)
def test_customer_id(spark, cookie, expected):
    assert one(spark, S.customer_id(F.col("c")), c=cookie) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("test@test.com", "test@test.com"),
        (" x ", " x "),
        ("", "Not Defined"),
        (None, "Not Defined"),
        (" \t", "Not Defined"),
        ("  \x1c", "Not Defined"),
    ],
)
def test_text_or_unknown(spark, text, expected):
    assert one(spark, S.text_or_unknown(F.col("t")), t=text) == expected


def test_white_space_is_complete():
    every = {chr(c) for c in range(0x110000) if chr(c).isspace()}
    assert set(S._WHITE_SPACE) == every


@pytest.mark.parametrize(
    "agent, resolution, label",
    [
        (CHROME, "1920x1080", f"{CHROME}_1920x1080"),
        ("", "", "Not Defined_Not Defined"),
        (None, "390x844", "Not Defined_390x844"),
        (CHROME, None, f"{CHROME}_Not Defined"),
    ],
)
def test_device_id(spark, agent, resolution, label):
    found = one(spark, S.device_id(F.col("a"), F.col("r")), a=agent, r=resolution)
    assert found == hashlib.sha256(label.encode()).hexdigest()


@pytest.mark.parametrize(
    "stamp, expected",
    [
        (1672574400, "2023-01-01 12:00:00"),
        (1672574400000, "2023-01-01 12:00:00"),
        (1672574400123, "2023-01-01 12:00:00.123"),
        (9999999999, "2286-11-20 17:46:39"),
        (10000000000, "1970-04-26 17:46:40"),
        (0, "1970-01-01 00:00:00"),
        (-1, "1969-12-31 23:59:59"),
        (9223372036854775807, None),
        (-9223372036854775808, None),
        (253402300799999, "9999-12-31 23:59:59.999"),
        (253402300800000, None),
    ],
)
def test_event_time(spark, stamp, expected):
    assert one(spark, S.event_time(F.col("t")).cast("string"), t=stamp) == expected


def test_date_attributes(spark):
    row = spark.sql("select date'2023-01-01' d").select(*S.date_attributes(F.col("d"))).first()
    assert tuple(row) == (
        20230101, dt.date(2023, 1, 1), "Sunday", "Sun", "weekend", 1, 1, 52, 1, 2023, "202301",
    )


def test_date_attributes_follow_the_calendar(spark):
    days = spark.sql("select explode(sequence(date'2019-12-25', date'2025-01-10')) d")
    for row in days.select(*S.date_attributes(F.col("d"))).collect():
        day = row["full_date"]
        assert row["date_id"] == int(day.strftime("%Y%m%d"))
        assert row["date_of_week"] == day.strftime("%A")
        assert row["date_of_week_short"] == day.strftime("%a")
        assert row["is_weekday_or_weekend"] == ("weekend" if day.weekday() >= 5 else "weekday")
        assert row["day_of_year"] == day.timetuple().tm_yday
        assert row["week_of_year"] == day.isocalendar()[1]
        assert row["quarter_number"] == (day.month - 1) // 3 + 1
        assert row["year_month"] == day.strftime("%Y%m")


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2023-01-01T12:00:00+00:00", dt.date(2023, 1, 1)),
        ("2023-01-01T23:30:00-05:00", dt.date(2023, 1, 1)),
        ("2023-01-01", dt.date(2023, 1, 1)),
        ("2023-01-01 12:00:00.123456", dt.date(2023, 1, 1)),
        ("2023-02-30", None),
        ("2023-01-01T25:00:00", None),
        ("invalid-date", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_date(spark, text, expected):
    assert one(spark, S.iso_date(F.col("t")), t=text) == expected


def test_date_of_inverts_date_id(spark):
    days = spark.sql("select explode(sequence(date'2023-12-01', date'2024-03-05')) d")
    wrong = days.filter(S.date_of(S.date_id(F.col("d"))) != F.col("d"))
    assert wrong.count() == 0


def test_fact_id(spark):
    keys = [F.lit(1), F.lit(None).cast("bigint"), F.lit(3), F.lit(4), F.lit(5), F.lit(20240105)]
    expected = hashlib.sha256(b"1_NA_3_4_5_20240105_1704448800").hexdigest()
    assert one(spark, S.fact_id(keys, F.col("t")), t=1704448800) == expected
    missing = hashlib.sha256(b"1_NA_3_4_5_20240105_NA").hexdigest()
    assert one(spark, S.fact_id(keys, F.col("t").cast("bigint")), t=None) == missing


@pytest.mark.parametrize(
    "agent, browser, system",
    [
        (CHROME, "Chrome", "Windows"),
        (IPHONE, "Mobile Safari", "iOS"),
        (None, "Unknown", "Unknown"),
        ("", "Unknown", "Unknown"),
        ("something else", "Other", "Other"),
        (CHROME + " Edg/120.0.2210.91", "Edge", "Windows"),
        (CHROME + " OPR/92.0.0.0", "Opera", "Windows"),
        ("Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0",
         "Firefox", "Ubuntu"),
        ("Mozilla/5.0 (Linux; Android 13; SM-S901B) AppleWebKit/537.36 (KHTML, like Gecko) "
         "SamsungBrowser/20.0 Chrome/106.0.5249.126 Mobile Safari/537.36",
         "Samsung Internet", "Android"),
        ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_5 like Mac OS X) AppleWebKit/605.1.15 "
         "(KHTML, like Gecko) CriOS/114.0.5735.99 Mobile/15E148 Safari/604.1",
         "Chrome Mobile iOS", "iOS"),
        ("Mozilla/5.0 (Windows NT 10.0; WOW64; Trident/7.0; rv:11.0) like Gecko", "IE", "Windows"),
    ],
)
def test_user_agent(spark, agent, browser, system):
    found = one(spark, useragent.user_agent_families(F.col("a")), a=agent)
    assert (found["browser"], found["os"]) == (browser, system)


@pytest.mark.parametrize(
    "ip, expected",
    [
        ("1.0.0.0", 16777216),
        ("255.255.255.255", 4294967295),
        ("0.0.0.0", 0),
        ("256.1.1.1", None),
        ("1.2.3", None),
        ("1.2.3.4.5", None),
        ("01.2.3.4", None),
        (" 1.2.3.4", None),
        ("1.2.3.-4", None),
        ("1..2.3", None),
        ("not-an-ip", None),
        ("::1", None),
        ("", None),
        (None, None),
    ],
)
def test_ip_to_long(spark, ip, expected):
    assert one(spark, geo.ip_to_long(F.col("ip")), ip=ip) == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.ip_addresses(v=4).map(str), st.text("0123456789. ", max_size=16)),
                min_size=20, max_size=60))
def test_ip_to_long_agrees_with_the_standard_library(spark, texts):
    def expected(text):
        try:
            return int(ipaddress.IPv4Address(text))
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "ip string")
    found = df.select("ip", geo.ip_to_long(F.col("ip")).alias("n")).collect()
    assert [r["n"] for r in found] == [expected(r["ip"]) for r in found]


def test_location_id(spark):
    parts = [F.lit("United States"), F.lit("California"), F.lit("San Jose")]
    expected = hashlib.md5(b"United States|California|San Jose").hexdigest()
    assert one(spark, geo.location_id(*parts)) == expected
    empty = [F.lit("France"), F.lit(None).cast("string"), F.lit("Paris")]
    assert one(spark, geo.location_id(*empty)) == hashlib.md5(b"France||Paris").hexdigest()
