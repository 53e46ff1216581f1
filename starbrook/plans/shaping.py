"""The event feed, range data and run log, shaped from the generic test tables.

Whole tables are used; purchases are delivered twice, as an at-least-once feed would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.schemas import EVENT_SCHEMA, IP_RANGE_SCHEMA

# One user agent per family the reports should tell apart.
USER_AGENTS = [
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/91.0.4472.124 Safari/537.36",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 14_6 like Mac OS X) AppleWebKit/605.1.15 "
    "(KHTML, like Gecko) Version/14.1.1 Mobile/15E148 Safari/604.1",
    "Mozilla/5.0 (X11; Linux x86_64; rv:109.0) Gecko/20100101 Firefox/115.0",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/120.0.0.0 Safari/537.36 Edg/120.0.2210.91",
    "Mozilla/5.0 (Linux; Android 13; Pixel 7) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/114.0.0.0 Mobile Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 "
    "(KHTML, like Gecko) Version/16.1 Safari/605.1.15",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/106.0.0.0 Safari/537.36 OPR/92.0.0.0",
]
# Last delivery slice; slices are ten days each.
LAST_SLICE = 2


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with an instant instead of a zoneless time, and the product number."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("i"),
        F.col("user_id").alias("u"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").alias("k"),
        "props",
    )


def _every(n: int) -> Column:
    return F.col("i") % n == 0


def raw_events(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """Columns of the wire format, plus ``ts`` and ``slice`` (the delivery they arrive in).

    A row group is read by one task, which would also encode and prepare all its events. With ``dealt``
    the rows, still narrow, are dealt over all tasks first, however the file is laid out.
    """
    base = events(spark, sf_dir)
    again = base.filter(F.col("event_type") == "purchase").withColumn("copy", F.lit(1))
    feed = base.withColumn("copy", F.lit(0)).unionByName(again)
    if dealt:
        feed = feed.repartition("i", "ts", "copy")
    i, u, k = F.col("i"), F.col("u"), F.col("k")

    agent = F.when(u % 9 == 7, F.lit(""))
    for position, text in enumerate(USER_AGENTS):
        agent = agent.when(u % 9 == position, F.lit(text))
    number = lambda c: c.cast("string")
    octets = [number(1 + u % 25), number(u % 256), number(i % 256), number(7 * i % 256)]
    columns = {
        "id": number(i),
        "api_version": F.lit("1.0"),
        "collection": F.col("event_type"),
        "current_url": F.concat(F.lit("https://shop.test/p/"), k),
        "device_id": F.when(~_every(53), F.concat(F.lit("d"), number(u))),
        "user_id_db": F.when(u % 5 == 1, F.lit("  ")).when(u % 5 != 0, number(u)),
        "resolution": F.when(u % 4 == 0, F.lit("1920x1080"))
        .when(u % 4 == 1, F.lit("390x844"))
        .when(u % 4 == 2, F.lit(" ")),
        "email_address": F.when(_every(3), F.lit("")).otherwise(
            F.concat(F.lit("u"), number(u), F.lit("+"), number(i % 2), F.lit("@mail.test"))
        ),
        "ip": F.when(_every(59), F.lit("not-an-ip")).when(~_every(61), F.concat_ws(".", *octets)),
        "local_time": F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        "option": F.array(
            F.struct(
                F.lit("color").alias("option_id"),
                number(k.cast("int") % 5).alias("option_label"),
            )
        ),
        "product_id": F.when(~_every(37), k),
        "referrer_url": F.when(
            ~_every(29), F.concat(F.lit("https://ref"), number(u % 12), F.lit(".test/"))
        ),
        "store_id": F.when(_every(41), F.lit(None))
        .when(_every(43), F.lit(""))
        .otherwise(number(i % 7)),
        "time_stamp": F.when(_every(2), F.unix_seconds("ts")).otherwise(F.unix_millis("ts")),
        "user_agent": agent,
    }
    decade = F.floor((F.dayofmonth("ts") - 1) / 10).cast("int")
    return feed.select(
        *(columns[name].alias(name) for name in EVENT_SCHEMA.fieldNames()),
        "ts",
        F.least(decade + F.col("copy"), F.lit(LAST_SLICE)).alias("slice"),
    )


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two halves of one /8 per nation; malformed and missing addresses match nothing."""
    half = 1 << 23
    nations = read(spark, sf_dir, "nation")
    regions = read(spark, sf_dir, "region")
    key = F.col("n_nationkey").cast("bigint")
    located = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).withColumn(
        "h", F.explode(F.array(F.lit(0), F.lit(1)))
    )
    start = (key + 1) * (1 << 24) + F.col("h") * half
    return located.select(
        start.alias("ip_from"),
        (start + half - 1).alias("ip_to"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_short"),
        F.col("n_name").alias("country_name"),
        F.col("r_name").alias("region_name"),
        F.concat_ws("_", "n_name", F.col("h").cast("string")).alias("city_name"),
    ).select(*IP_RANGE_SCHEMA.fieldNames())


def job_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a run of one of four jobs; errors are failed runs."""
    return events(spark, sf_dir).select(
        F.concat(F.lit("job"), (F.col("u") % 4).cast("string")).alias("job_id"),
        F.col("i").alias("run_id"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("state"),
        F.col("ts").alias("start_date"),
        F.col("ts").alias("end_date"),
    )
