"""Declared schemas. Nothing is inferred.

Surrogate keys are BIGINT: at the volumes this is meant for, cookies can outnumber a 32-bit key.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, WHOLE, LONG, REAL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DAY, INSTANT, MONEY = T.DateType(), T.TimestampType(), T.DecimalType(38, 18)


def columns(required: tuple[str, ...] = (), **types: T.DataType) -> T.StructType:
    """Columns in the order given; ``required`` ones may not be null."""
    return T.StructType([T.StructField(n, t, n not in required) for n, t in types.items()])


# Wire format of one event.
EVENT_SCHEMA = columns(
    id=TEXT,
    api_version=TEXT,
    collection=TEXT,
    current_url=TEXT,
    device_id=TEXT,
    user_id_db=TEXT,
    resolution=TEXT,
    email_address=TEXT,
    ip=TEXT,
    local_time=TEXT,
    option=T.ArrayType(columns(option_id=TEXT, option_label=TEXT)),
    product_id=TEXT,
    referrer_url=TEXT,
    store_id=TEXT,
    time_stamp=LONG,
    user_agent=TEXT,
)

LOCATION_SCHEMA = columns(
    location_id=TEXT, country_name=TEXT, country_short=TEXT, region_name=TEXT, city_name=TEXT
)

IP_RANGE_SCHEMA = columns(
    ip_from=LONG,
    ip_to=LONG,
    country_short=TEXT,
    country_name=TEXT,
    region_name=TEXT,
    city_name=TEXT,
)

# The star schema. Primary keys and mandatory attributes may not be null.
STAR_TABLES: dict[str, T.StructType] = {
    "fact_product_views": columns(
        ("fact_id",),
        fact_id=TEXT,
        product_key=LONG,
        store_key=LONG,
        location_key=LONG,
        customer_key=LONG,
        device_key=LONG,
        date_id=WHOLE,
        ip_address=TEXT,
        time_stamp=INSTANT,
        collection=TEXT,
        current_url=TEXT,
        referrer_url=TEXT,
    ),
    "dim_customer": columns(
        ("customer_key",),
        customer_key=LONG,
        customer_id=TEXT,
        email_address=TEXT,
        user_id_db=TEXT,
    ),
    "dim_device": columns(
        ("device_key",),
        device_key=LONG,
        device_id=TEXT,
        user_agent=TEXT,
        resolution=TEXT,
        os=TEXT,
        browser=TEXT,
    ),
    "dim_product": columns(
        ("product_key",),
        product_key=LONG,
        product_id=TEXT,
        suffix=TEXT,
        product_name=TEXT,
        sku=TEXT,
        attribute_set_id=WHOLE,
        type_id=TEXT,
        min_price=MONEY,
        max_price=MONEY,
        collection_id=TEXT,
        product_type_value=TEXT,
        product_subtype_id=WHOLE,
        store_code=TEXT,
        gender=TEXT,
    ),
    "dim_store": columns(("store_key",), store_key=LONG, store_id=TEXT, store_name=TEXT),
    "dim_location": columns(
        ("location_key",),
        location_key=LONG,
        location_id=TEXT,
        country_name=TEXT,
        country_short=TEXT,
        region_name=TEXT,
        city_name=TEXT,
    ),
    "dim_date": columns(
        ("date_id", "full_date"),
        date_id=WHOLE,
        full_date=DAY,
        date_of_week=TEXT,
        date_of_week_short=TEXT,
        is_weekday_or_weekend=TEXT,
        day_of_month=WHOLE,
        day_of_year=WHOLE,
        week_of_year=WHOLE,
        quarter_number=WHOLE,
        year_number=WHOLE,
        year_month=TEXT,
    ),
}

# Foreign keys of the fact table: fact column -> (dimension, its key column).
FACT_REFERENCES: dict[str, tuple[str, str]] = {
    "product_key": ("dim_product", "product_key"),
    "store_key": ("dim_store", "store_key"),
    "location_key": ("dim_location", "location_key"),
    "customer_key": ("dim_customer", "customer_key"),
    "device_key": ("dim_device", "device_key"),
    "date_id": ("dim_date", "date_id"),
}

# Winning event time per attribute, kept beside a customer so that late events cannot win.
CUSTOMER_STATE = columns(email_seen_at=LONG, user_seen_at=LONG)

RUN_LOG_SCHEMA = columns(
    job_id=TEXT,
    feed=TEXT,
    run_id=LONG,
    attempt=LONG,
    state=TEXT,
    start_date=INSTANT,
    end_date=INSTANT,
    input_rows=LONG,
    rejected_rows=LONG,
    fact_rows=LONG,
    key_high_water=T.MapType(TEXT, LONG),
    error=TEXT,
)

# Additive counts of one batch, by table and metric; ``name`` is a column or a reference.
QUALITY_SCHEMA = columns(table_name=TEXT, metric=TEXT, name=TEXT, key=LONG, day=WHOLE, n=LONG)

REJECT_SCHEMA = columns(raw_value=TEXT, reject_reason=TEXT)
