"""The registered queries in DuckDB SQL, written from the table definitions alone."""

from __future__ import annotations

from starbrook.plans.catalog import (
    AS_OF,
    COUNTRY,
    EVENT_LIMIT_MILLIS,
    EXPECTED_MINIMUM,
    JOBS_AS_OF,
    JOBS_WINDOW_MINUTES,
    MIRROR_FILES,
)
from starbrook.plans.shaping import LAST_SLICE, USER_AGENTS

_AGENT_CASE = " ".join(f"WHEN {n} THEN '{text}'" for n, text in enumerate(USER_AGENTS))

# Families of the test user agents, in their order.
_FAMILIES = [
    ("Chrome", "Windows"),
    ("Mobile Safari", "iOS"),
    ("Firefox", "Linux"),
    ("Edge", "Windows"),
    ("Chrome Mobile", "Android"),
    ("Safari", "Mac OS X"),
    ("Opera", "Windows"),
]
_BROWSER_CASE = " ".join(f"WHEN '{a}' THEN '{f[0]}'" for a, f in zip(USER_AGENTS, _FAMILIES))
_OS_CASE = " ".join(f"WHEN '{a}' THEN '{f[1]}'" for a, f in zip(USER_AGENTS, _FAMILIES))

_RAW = f"""
base AS (
  SELECT event_id AS i, user_id AS u, ts, event_type, value,
         json_extract_string(props, '$.k') AS k FROM events),
feed AS (
  SELECT *, 0 AS copy FROM base
  UNION ALL SELECT *, 1 AS copy FROM base WHERE event_type = 'purchase'),
raw AS (
  SELECT CAST(i AS VARCHAR) AS id, '1.0' AS api_version, event_type AS collection,
    'https://shop.test/p/' || k AS current_url,
    CASE WHEN i % 53 <> 0 THEN 'd' || u END AS device_id,
    CASE WHEN u % 5 = 1 THEN '  ' WHEN u % 5 <> 0 THEN CAST(u AS VARCHAR) END AS user_id_db,
    CASE u % 4 WHEN 0 THEN '1920x1080' WHEN 1 THEN '390x844' WHEN 2 THEN ' ' END AS resolution,
    CASE WHEN i % 3 = 0 THEN '' ELSE 'u' || u || '+' || (i % 2) || '@mail.test' END
      AS email_address,
    CASE WHEN i % 59 = 0 THEN 'not-an-ip' WHEN i % 61 <> 0
      THEN (1 + u % 25) || '.' || (u % 256) || '.' || (i % 256) || '.' || ((7 * i) % 256) END AS ip,
    CASE WHEN i % 59 <> 0 AND i % 61 <> 0 THEN
      (1 + u % 25) * 16777216 + (u % 256) * 65536 + (i % 256) * 256 + (7 * i) % 256 END AS address,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS local_time,
    '[{{"option_id":"color","option_label":"' || (CAST(k AS INT) % 5) || '"}}]' AS option,
    CASE WHEN i % 37 <> 0 THEN k END AS product_id,
    CASE WHEN i % 29 <> 0 THEN 'https://ref' || (u % 12) || '.test/' END AS referrer_url,
    CASE WHEN i % 41 = 0 THEN NULL WHEN i % 43 = 0 THEN '' ELSE CAST(i % 7 AS VARCHAR) END
      AS store_id,
    CASE WHEN i % 2 = 0 THEN epoch_us(ts) // 1000000 ELSE epoch_us(ts) // 1000 END AS time_stamp,
    CASE u % 9 {_AGENT_CASE} WHEN 7 THEN '' END AS user_agent,
    i, ts, least((dayofmonth(ts) - 1) // 10 + copy, {LAST_SLICE}) AS slice
  FROM feed)"""

_RANGES = """
ranges AS (
  SELECT (n_nationkey + 1) * CAST(16777216 AS BIGINT) + h * 8388608 AS ip_from,
    (n_nationkey + 1) * CAST(16777216 AS BIGINT) + h * 8388608 + 8388607 AS ip_to,
    'N' || n_nationkey AS country_short, n_name AS country_name, r_name AS region_name,
    n_name || '_' || h AS city_name,
    md5(n_name || '|' || r_name || '|' || n_name || '_' || h) AS location_id
  FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES (0), (1)) halves(h))"""


def _known(column: str) -> str:
    return f"CASE WHEN {column} IS NULL OR trim({column}) = '' THEN 'Not Defined' ELSE {column} END"


def _star(batch: str) -> str:
    """The whole star schema; ``batch`` is the delivery a row arrives in."""
    return f"""WITH {_RAW}, {_RANGES},
prepared AS (
  SELECT raw.*, {batch} AS batch,
    CASE WHEN device_id IS NULL OR device_id = '' THEN '-1' ELSE device_id END AS customer_id,
    {_known('email_address')} AS email, {_known('user_id_db')} AS uid,
    {_known('user_agent')} AS ua, {_known('resolution')} AS res,
    CASE WHEN coalesce(user_agent, '') <> '' OR coalesce(resolution, '') <> ''
      THEN sha256({_known('user_agent')} || '_' || {_known('resolution')}) END AS device_hash,
    CASE WHEN time_stamp > 9999999999 THEN time_stamp ELSE time_stamp * 1000 END AS millis,
    location_id, country_name, country_short, region_name, city_name
  FROM raw LEFT JOIN ranges ON address BETWEEN ip_from AND ip_to),
timed AS (
  SELECT *, make_timestamp(millis * 1000) AS event_time,
    CAST(strftime(make_timestamp(millis * 1000), '%Y%m%d') AS INT) AS date_id FROM prepared),
dim_product AS (
  SELECT row_number() OVER (ORDER BY min(batch), product_id) AS product_key, product_id
  FROM timed WHERE product_id <> '' GROUP BY product_id),
dim_store AS (
  SELECT row_number() OVER (ORDER BY min(batch), store_id) AS store_key, store_id,
    'Store ' || store_id AS store_name
  FROM timed WHERE store_id <> '' GROUP BY store_id),
dim_location AS (
  SELECT row_number() OVER (ORDER BY min(batch), location_id) AS location_key, location_id,
    min(country_name) AS country_name, min(country_short) AS country_short,
    min(region_name) AS region_name, min(city_name) AS city_name
  FROM timed WHERE location_id IS NOT NULL GROUP BY location_id),
dim_device AS (
  SELECT row_number() OVER (ORDER BY min(batch), device_hash) AS device_key,
    device_hash AS device_id, min(ua) AS user_agent, min(res) AS resolution,
    CASE min(ua) {_OS_CASE} ELSE 'Unknown' END AS os,
    CASE min(ua) {_BROWSER_CASE} ELSE 'Unknown' END AS browser
  FROM timed WHERE device_hash IS NOT NULL GROUP BY device_hash),
emails AS (
  SELECT customer_id, email, row_number() OVER (
    PARTITION BY customer_id ORDER BY millis DESC, email DESC) AS n
  FROM timed WHERE email <> 'Not Defined'),
uids AS (
  SELECT customer_id, uid, row_number() OVER (
    PARTITION BY customer_id ORDER BY millis DESC, uid DESC) AS n
  FROM timed WHERE uid <> 'Not Defined'),
customers AS (
  SELECT customer_id, row_number() OVER (ORDER BY min(batch), customer_id) AS customer_key
  FROM timed GROUP BY customer_id),
dim_customer AS (
  SELECT customer_key, c.customer_id, coalesce(email, 'Not Defined') AS email_address,
    coalesce(uid, 'Not Defined') AS user_id_db
  FROM customers c LEFT JOIN emails e ON c.customer_id = e.customer_id AND e.n = 1
  LEFT JOIN uids u ON c.customer_id = u.customer_id AND u.n = 1),
days AS (SELECT DISTINCT date_id, CAST(event_time AS DATE) AS d FROM timed),
dim_date AS (
  SELECT date_id, d AS full_date, dayname(d) AS date_of_week,
    substr(dayname(d), 1, 3) AS date_of_week_short,
    CASE WHEN isodow(d) >= 6 THEN 'weekend' ELSE 'weekday' END AS is_weekday_or_weekend,
    CAST(dayofmonth(d) AS INT) AS day_of_month, CAST(dayofyear(d) AS INT) AS day_of_year,
    CAST(weekofyear(d) AS INT) AS week_of_year, CAST(quarter(d) AS INT) AS quarter_number,
    CAST(year(d) AS INT) AS year_number, strftime(d, '%Y%m') AS year_month FROM days),
keyed AS (
  SELECT t.*, product_key, store_key, location_key, customer_key, device_key
  FROM timed t LEFT JOIN dim_product p ON t.product_id = p.product_id
  LEFT JOIN dim_store s ON t.store_id = s.store_id
  LEFT JOIN dim_location l ON t.location_id = l.location_id
  LEFT JOIN dim_customer c ON t.customer_id = c.customer_id
  LEFT JOIN dim_device v ON t.device_hash = v.device_id),
hashed AS (
  SELECT *, sha256(concat_ws('_', coalesce(CAST(product_key AS VARCHAR), 'NA'),
    coalesce(CAST(store_key AS VARCHAR), 'NA'), coalesce(CAST(location_key AS VARCHAR), 'NA'),
    coalesce(CAST(customer_key AS VARCHAR), 'NA'), coalesce(CAST(device_key AS VARCHAR), 'NA'),
    coalesce(CAST(date_id AS VARCHAR), 'NA'), coalesce(CAST(time_stamp AS VARCHAR), 'NA')))
    AS fact_id FROM keyed),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY fact_id ORDER BY batch, id, ip NULLS FIRST, collection,
    current_url, referrer_url NULLS FIRST) AS place FROM hashed),
fact AS (
  SELECT fact_id, product_key, store_key, location_key, customer_key, device_key, date_id,
    ip AS ip_address, event_time AS time_stamp, collection, current_url, referrer_url, batch
  FROM placed WHERE place = 1),
newest AS (SELECT max(date_id) AS day FROM fact),
today AS (SELECT fact.* FROM fact, newest WHERE date_id = day)
"""


_ONCE, _SLICES = _star("0"), _star("slice")

_FACT_COLUMNS = (
    "fact_id, product_key, store_key, location_key, customer_key, device_key, date_id, "
    "ip_address, time_stamp, collection, current_url, referrer_url"
)

_DIMENSION_KEYS = {
    "dim_product": ("product_id", "product_key", "product_id"),
    "dim_store": ("store_id", "store_key", "store_id"),
    "dim_location": ("location_id", "location_key", "location_id"),
    "dim_customer": ("customer_id", "customer_key", "customer_id"),
    "dim_device": ("device_id", "device_key", "device_hash"),
}

_REFERENCES = {
    "product": "product_key",
    "store": "store_key",
    "location": "location_key",
    "customer": "customer_key",
    "device": "device_key",
    "date": "date_id",
}

_PRODUCT_REST = ", ".join(
    f"CAST(NULL AS {kind}) AS {name}"
    for kind, names in (
        ("VARCHAR", "suffix product_name sku type_id collection_id product_type_value store_code gender"),
        ("INTEGER", "attribute_set_id product_subtype_id"),
        ("DECIMAL(38,18)", "min_price max_price"),
    )
    for name in names.split()
)

_LOCATION = "location_id, country_name, country_short, region_name, city_name"


_LEADER = (
    "(SELECT product_id FROM today JOIN dim_product USING (product_key) "
    "GROUP BY product_id ORDER BY count(*) DESC, product_id LIMIT 1)"
)


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _all_keys(where: str = "", more: str = "") -> str:
    return _union(
        [
            f"SELECT '{table}' AS dimension, {natural} AS natural_id, {key} AS surrogate_key "
            + more.format(natural=f"{table}.{natural}", event=event)
            + f" FROM {table} {where.format(natural=natural, event=event)}"
            for table, (natural, key, event) in _DIMENSION_KEYS.items()
        ]
    )


def _table_columns() -> dict[str, tuple[list[str], list[str]]]:
    """Columns that are filled, and columns no feed fills, per table."""
    empty = [part.split(" AS ")[-1] for part in _PRODUCT_REST.split(", CAST")]
    return {
        "fact": (_FACT_COLUMNS.split(", "), []),
        "dim_customer": (["customer_key", "customer_id", "email_address", "user_id_db"], []),
        "dim_device": (["device_key", "device_id", "user_agent", "resolution", "os", "browser"], []),
        "dim_product": (["product_key", "product_id"], empty),
        "dim_store": (["store_key", "store_id", "store_name"], []),
        "dim_location": (["location_key", *_LOCATION.split(", ")], []),
        "dim_date": (
            "date_id full_date date_of_week date_of_week_short is_weekday_or_weekend day_of_month "
            "day_of_year week_of_year quarter_number year_number year_month".split(),
            [],
        ),
    }


def _display(table: str) -> str:
    return "fact_product_views" if table == "fact" else table


def _completeness() -> str:
    parts = []
    for table, (filled, empty) in _table_columns().items():
        nulls = " + ".join(f"count(*) - count({c})" for c in filled)
        parts.append(
            f"SELECT '{_display(table)}' AS table_name, count(*) AS total_rows, "
            f"{len(filled) + len(empty)} AS columns, {nulls} + {len(empty)} * count(*) AS null_cells "
            f"FROM {table}"
        )
    return f"""cells AS ({_union(parts)}),
shares AS (SELECT *, CAST(round_even(
    (1 - null_cells / greatest(total_rows * columns, 1)) * 100, 2) AS DOUBLE) AS completeness_pct
  FROM cells),
graded AS (SELECT *, CASE WHEN completeness_pct >= 90 THEN 'ok' WHEN completeness_pct >= 70
  THEN 'warn' ELSE 'fail' END AS grade FROM shares)"""


def _completeness_by_day() -> str:
    filled = _table_columns()["fact"][0]
    nulls = " + ".join(f"count(*) - count({c})" for c in filled)
    return f"""cells AS (SELECT date_id, count(*) AS total_rows, {len(filled)} AS columns,
    {nulls} AS null_cells FROM fact GROUP BY date_id),
shares AS (SELECT *, CAST(round_even(
    (1 - null_cells / greatest(total_rows * columns, 1)) * 100, 2) AS DOUBLE) AS completeness_pct
  FROM cells)
SELECT *, CASE WHEN completeness_pct >= 90 THEN 'ok' WHEN completeness_pct >= 70
  THEN 'warn' ELSE 'fail' END AS grade FROM shares"""


def _orphans() -> str:
    """References against dimensions that only know the members of the first day."""
    parts = []
    for name, key in _REFERENCES.items():
        seen = f"(SELECT DISTINCT {key} FROM fact WHERE date_id = (SELECT min(date_id) FROM fact))"
        lost = f"f.{key} IS NOT NULL AND s.{key} IS NULL"
        parts.append(
            f"SELECT 'no_orphan_{name}' AS check_name, count(*) AS total_rows, "
            f"count(CASE WHEN {lost} THEN 1 END) AS orphan_rows, "
            f"count(DISTINCT CASE WHEN {lost} THEN f.{key} END) AS orphan_keys, "
            f"count(*) - count(f.{key}) AS null_rows "
            f"FROM fact f LEFT JOIN {seen} s ON f.{key} = s.{key}"
        )
    return _union(parts)


def _error_rate() -> str:
    first_day = "(SELECT min(date_id) FROM fact)"
    parts = ["SELECT 'fact_product_views' AS table_name, 'null_key' AS check_name, count(*) AS total_rows, 0 AS error_rows FROM fact"]
    for name, key in _REFERENCES.items():
        parts.append(
            f"SELECT 'dim_{name}', 'null_key', count(DISTINCT {key}), 0 FROM fact "
            f"WHERE date_id = {first_day}"
        )
    return f"""lost AS ({_orphans()}),
checks AS ({_union(parts)} UNION ALL
  SELECT 'fact_product_views', replace(check_name, 'no_orphan', 'missing'), total_rows,
    orphan_rows + null_rows FROM lost)
SELECT *, CAST(round_even(error_rows / greatest(total_rows, 1) * 100, 2) AS DOUBLE) AS error_pct,
  total_rows >= {EXPECTED_MINIMUM} AS meets_minimum FROM checks"""


_EXPECTATIONS = """expected AS (
  SELECT 'no_orphan_customer' AS name, CAST(count(DISTINCT f.customer_key) AS VARCHAR) AS actual
  FROM fact f ANTI JOIN dim_customer d ON f.customer_key = d.customer_key
  WHERE f.customer_key IS NOT NULL
  UNION ALL SELECT 'no_orphan_product', CAST(count(DISTINCT f.product_key) AS VARCHAR)
  FROM fact f ANTI JOIN dim_product d ON f.product_key = d.product_key
  WHERE f.product_key IS NOT NULL
  UNION ALL SELECT 'no_duplicate_events', CAST(count(*) - count(DISTINCT fact_id) AS VARCHAR) FROM fact
  UNION ALL SELECT 'feed_has_no_repeats', CAST(count(*) - count(DISTINCT id) AS VARCHAR) FROM raw
  UNION ALL SELECT 'unknown_column', NULL),
outcomes AS (SELECT name, '0' AS expected, actual,
  CASE WHEN actual IS NULL THEN 'error' WHEN actual = '0' THEN 'passed' ELSE 'failed' END AS status
  FROM expected)"""


def _quality_report() -> str:
    tables = list(_table_columns())
    schema = _union(
        [f"SELECT 'schema' AS section, '{_display(t)}' AS name, true AS passed" for t in tables]
    )
    errors = _union(
        [
            f"SELECT 'error_rate' AS section, '{_display(t)}' AS name, "
            f"count(*) >= {EXPECTED_MINIMUM} AND count(*) = count({c[0][0]}) AS passed FROM {t}"
            for t, c in _table_columns().items()
        ]
    )
    return f""", {_completeness()}, {_EXPECTATIONS},
report AS (
  SELECT 'completeness' AS section, table_name AS name, grade <> 'fail' AS passed FROM graded
  UNION ALL {schema} UNION ALL {errors}
  UNION ALL SELECT 'expectation', name, status = 'passed' FROM outcomes)
SELECT * FROM report UNION ALL
SELECT 'overall', CASE WHEN bool_and(passed) THEN 'HEALTHY' ELSE 'DEGRADED' END, bool_and(passed)
FROM report"""


_JOBS = f"""jobs AS (
  SELECT 'job' || (user_id % 4) AS job_id, count(*) AS failed_runs, max(ts) AS last_failure
  FROM events WHERE event_type = 'error'
    AND ts >= TIMESTAMP '{JOBS_AS_OF}' - INTERVAL {JOBS_WINDOW_MINUTES} MINUTE GROUP BY 1)"""

_ALERTS = f""", {_JOBS},
alerts AS (
  SELECT 'fact_table_empty' AS name, 'Fact table has no data' AS description, 'HIGH' AS severity,
    2 AS priority, 0 AS rule_order FROM fact HAVING count(*) <= 0
  UNION ALL SELECT 'low_data_quality', 'Data quality check found issues', 'MEDIUM', 3, 1
    FROM fact HAVING count(*) - count(DISTINCT fact_id) > 0
  UNION ALL SELECT 'high_storage_usage', 'Database storage is growing unusually', 'LOW', 4, 2
    FROM fact HAVING count(*) / count(CASE WHEN dayofmonth(time_stamp) <= 10 THEN 1 END) > 1.5
  UNION ALL SELECT 'dag_failure_detected', 'Failed DAGs detected in the last {JOBS_WINDOW_MINUTES} mins: '
    || string_agg(job_id, ', ' ORDER BY job_id), 'CRITICAL', 1, 3 FROM jobs HAVING count(*) > 0
  UNION ALL SELECT 'data_stagnation',
    'Streaming stuck: No new data in fact_product_views since '
    || strftime(max(time_stamp), '%H:%M:%S') || ' (>10 mins delay)', 'HIGH', 2, 4
    FROM fact HAVING max(time_stamp) < TIMESTAMP '{AS_OF}' - INTERVAL 10 MINUTE
  UNION ALL SELECT 'feed_repeats', 'The feed delivered messages twice', 'MEDIUM', 3, 5
    FROM raw HAVING count(*) - count(DISTINCT id) > 0
  UNION ALL SELECT 'feed_small', 'The feed has too few messages', 'NOTICE', 5, 6
    FROM raw HAVING count(*) <= 1e12)"""


def _feed_lag(window_filter: str) -> str:
    return f"""WITH timed AS (
  SELECT epoch_us(ts) // 1000 AS at, ts, CAST(round(value * 1000) AS BIGINT) AS behind FROM events),
lagged AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS events,
    CAST(sum(behind) AS BIGINT) AS total_lag_ms, max(behind) AS max_lag_ms,
    count(CASE WHEN behind > {EVENT_LIMIT_MILLIS} THEN 1 END) AS late_events
  FROM timed GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, events, total_lag_ms, max_lag_ms,
  late_events, CASE WHEN max_lag_ms > {EVENT_LIMIT_MILLIS} THEN 'behind' ELSE 'healthy' END
  AS lag_status FROM lagged {window_filter}"""


def oracle_sql() -> dict[str, str]:
    raw = f"WITH {_RAW} "
    facts = f"SELECT {_FACT_COLUMNS} FROM fact"
    customers = "SELECT customer_key, customer_id, email_address, user_id_db FROM dim_customer"
    statements = {
        "event_parse": raw
        + "SELECT "
        + ", ".join(
            f"CASE WHEN i % 71 <> 0 THEN {c} END AS {c}"
            for c in (
                "id api_version collection current_url device_id user_id_db resolution "
                "email_address ip local_time product_id referrer_url store_id time_stamp "
                "user_agent option"
            ).split()
        )
        + ", CASE WHEN i % 71 = 0 THEN 'malformed_json' END AS reject_reason, "
        "CASE WHEN i % 71 = 0 THEN 'not json ' || id END AS raw_value FROM raw",
        "iso_dates": """
WITH texts AS (SELECT event_id, CASE event_id % 3
    WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+07:00'
    WHEN 1 THEN strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g')
    ELSE 'invalid-' || event_id END AS iso_text FROM events)
SELECT event_id, iso_text, TRY_CAST(substr(iso_text, 1, 10) AS DATE) AS iso_date FROM texts""",
        "epoch_normalize": raw
        + """, m AS (SELECT id, time_stamp, CASE WHEN time_stamp > 9999999999 THEN time_stamp
    ELSE time_stamp * 1000 END AS event_millis FROM raw)
SELECT *, make_timestamp(event_millis * 1000) AS event_time,
  CAST(strftime(make_timestamp(event_millis * 1000), '%Y%m%d') AS INT) AS date_id FROM m""",
        "ip_geolocate": raw
        + f", {_RANGES} SELECT id, ip, {_LOCATION} "
        "FROM raw LEFT JOIN ranges ON address BETWEEN ip_from AND ip_to",
        "date_dimension": _ONCE + "SELECT * FROM dim_date",
        "store_dimension": _ONCE + "SELECT * FROM dim_store",
        "product_dimension": _ONCE + f"SELECT *, {_PRODUCT_REST} FROM dim_product",
        "customer_dimension": _ONCE + customers,
        "device_dimension": _ONCE + "SELECT * FROM dim_device",
        "location_dimension": _ONCE + "SELECT * FROM dim_location",
        "fact_build": _ONCE + facts,
        "fact_incremental_upsert": _SLICES + facts,
        "customer_incremental_upsert": _SLICES + customers,
        "fact_ledger_upsert": _SLICES + facts,
        "stream_ingest": _SLICES + facts,
        "dimension_incremental_upsert": _SLICES + _all_keys(),
        "batch_key_lookup": _SLICES
        + _all_keys(
            f"WHERE {{natural}} IN (SELECT {{event}} FROM timed WHERE batch = {LAST_SLICE}) AND "
            f"{{natural}} IN (SELECT {{event}} FROM timed WHERE batch < {LAST_SLICE})",
            f", (SELECT count(*) FROM timed t WHERE t.batch = {LAST_SLICE} AND t.{{event}} = {{natural}}) AS events",
        ),
        "stream_ingest_suppressed": _SLICES + facts,
        "suppressed_repeats": _SLICES
        + """SELECT CAST(sum(1 + CAST(id AS BIGINT) % 3) AS BIGINT) AS delivered,
  CAST(sum(1 + CAST(id AS BIGINT) % 3) - count(DISTINCT id) AS BIGINT) AS cut,
  count(DISTINCT id) AS looked_up, (SELECT count(*) FROM fact) AS facts FROM timed""",
        "stream_run_log": _SLICES
        + """SELECT CAST(a.batch AS BIGINT) AS run_id, input_rows, CAST(0 AS BIGINT) AS rejected_rows,
  fact_rows FROM (SELECT batch, count(*) AS input_rows FROM timed GROUP BY 1) a
JOIN (SELECT batch, count(*) AS fact_rows FROM fact GROUP BY 1) b ON a.batch = b.batch""",
        "latest_report_date": _ONCE + "SELECT max(CAST(time_stamp AS DATE)) AS max_date FROM fact",
        "top_products": _ONCE
        + """SELECT row_number() OVER (ORDER BY count(*) DESC, product_id) AS rank, product_id,
  count(*) AS view_count FROM today JOIN dim_product USING (product_key)
GROUP BY product_id ORDER BY 1 LIMIT 10""",
        "top_countries": _ONCE
        + """SELECT row_number() OVER (ORDER BY count(*) DESC, country_name) AS rank, country_name,
  count(*) AS view_count FROM today JOIN dim_location USING (location_key)
GROUP BY country_name ORDER BY 1 LIMIT 10""",
        "top_referrers": _ONCE
        + """SELECT row_number() OVER (ORDER BY count(*) DESC, referrer_url NULLS FIRST) AS rank,
  referrer_url, count(*) AS view_count FROM today GROUP BY referrer_url ORDER BY 1 LIMIT 5""",
        "country_store_views": _ONCE
        + f"""SELECT row_number() OVER (ORDER BY count(*) DESC, store_id) AS rank, store_id,
  count(*) AS view_count FROM today JOIN dim_location USING (location_key)
JOIN dim_store USING (store_key) WHERE country_name = '{COUNTRY}' GROUP BY store_id""",
        "country_list": _ONCE
        + "SELECT DISTINCT country_name FROM dim_location WHERE country_name IS NOT NULL",
        "recent_products": _ONCE
        + """SELECT DISTINCT product_id FROM today JOIN dim_product USING (product_key)
ORDER BY product_id LIMIT 100""",
        "product_hourly_views": _ONCE
        + f"""SELECT CAST(hour(time_stamp) AS INT) AS hour, count(*) AS view_count
FROM today JOIN dim_product USING (product_key) WHERE product_id = {_LEADER} GROUP BY 1""",
        "product_total_views": _ONCE
        + f"""SELECT count(*) AS total_views
FROM today JOIN dim_product USING (product_key) WHERE product_id = {_LEADER}""",
        "browser_os_views": _ONCE
        + """SELECT row_number() OVER (ORDER BY count(*) DESC, browser, os) AS rank, browser, os,
  count(*) AS view_count FROM today JOIN dim_device USING (device_key) GROUP BY browser, os""",
        "browser_os_totals": _ONCE
        + """SELECT CASE grouping_id(browser, os) WHEN 0 THEN 'browser_os' WHEN 1 THEN 'browser'
  ELSE 'os' END AS level, browser, os, count(*) AS view_count
FROM today JOIN dim_device USING (device_key)
GROUP BY GROUPING SETS ((browser, os), (browser), (os))""",
        "completeness": _ONCE + f", {_completeness()} SELECT * FROM graded",
        "kept_completeness": _SLICES + f", {_completeness()} SELECT * FROM graded",
        "kept_completeness_by_day": _SLICES + f", {_completeness_by_day()}",
        "kept_error_rate": _SLICES + f", {_error_rate()} WHERE table_name = 'fact_product_views'",
        "orphans": _ONCE + _orphans(),
        "error_rate": _ONCE + f", {_error_rate()}",
        "duplicates": _ONCE
        + """, lines AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem),
counted AS (
  SELECT 'lineitem' AS table_name, (SELECT count(*) FROM lineitem) AS total_rows,
    (SELECT count(*) FROM lines) AS distinct_keys
  UNION ALL SELECT 'raw_events', count(*), count(DISTINCT product_id) FROM raw
  UNION ALL SELECT 'fact_product_views', count(*), count(DISTINCT fact_id) FROM fact)
SELECT *, total_rows - distinct_keys AS duplicate_rows FROM counted""",
        "expectations": _ONCE + f", {_EXPECTATIONS} SELECT * FROM outcomes",
        "quality_report": _ONCE + _quality_report(),
        "archival_candidates": _ONCE
        + f"""SELECT count(*) AS total_records,
  count(CASE WHEN time_stamp < TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY THEN 1 END)
    AS archival_candidates, 30 AS retention_days,
  count(CASE WHEN time_stamp < TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY THEN 1 END) > 0
    AS has_candidates FROM fact""",
        "retention_split": _ONCE
        + f"""SELECT CASE WHEN time_stamp < TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY THEN 'archive'
  ELSE 'live' END AS side, date_id, count(*) AS rows FROM fact GROUP BY 1, 2""",
        "archive_run": _SLICES
        + """SELECT CASE WHEN time_stamp < TIMESTAMP '2024-01-11 12:00:00' THEN 'archive'
  ELSE 'live' END AS side, fact_id, date_id FROM fact""",
        "compact": _SLICES
        + """SELECT fact_id, customer_key, customer_id, email_address, date_id
FROM fact LEFT JOIN dim_customer USING (customer_key)""",
        **dict.fromkeys(
            ("replay_after_compaction", "new_checkpoint", "repeat_with_fewer_days"),
            _SLICES
            + """SELECT fact_id, customer_key, customer_id, email_address, date_id
FROM fact LEFT JOIN dim_customer USING (customer_key)""",
        ),
        "storage_growth": _SLICES
        + """SELECT 'fact_product_views' AS table_name, count(CASE WHEN batch = 0 THEN 1 END) AS then_rows,
  count(*) AS rows, true AS as_listed, count(*) / count(CASE WHEN batch = 0 THEN 1 END) > 1.5 AS unusual
FROM fact""",
        "alerts": _ONCE + _ALERTS + " SELECT * FROM alerts",
        "alert_summary": _ONCE
        + _ALERTS
        + """ SELECT count(*) AS total, count(CASE severity WHEN 'CRITICAL' THEN 1 END) AS critical,
  count(CASE severity WHEN 'HIGH' THEN 1 END) AS high,
  count(CASE severity WHEN 'MEDIUM' THEN 1 END) AS medium,
  count(CASE severity WHEN 'LOW' THEN 1 END) AS low,
  count(CASE severity WHEN 'CRITICAL' THEN 1 END) > 0 AS requires_escalation FROM alerts""",
        "alert_classes": _ONCE
        + _ALERTS
        + """ SELECT severity, CAST(row_number() OVER (PARTITION BY severity ORDER BY rule_order) AS INT)
  AS place, name FROM alerts""",
        # whether a rule is skipped depends on the declared columns alone
        "alerts_skipped": """SELECT 'feed_late' AS name, 'HIGH' AS severity,
  'UNRESOLVED_COLUMN.WITH_SUGGESTION' AS reason
WHERE NOT EXISTS (SELECT 1 FROM (DESCRIBE events) WHERE column_name = 'arrived')""",
        "failed_jobs": f"WITH {_JOBS} SELECT * FROM jobs",
        "feed_throughput": """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS events
FROM events GROUP BY 1, 2, 3""",
        "feed_lag": _feed_lag(""),
        "stream_throughput": """
WITH counted AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS events
  FROM events GROUP BY 1)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, events FROM counted""",
        "stream_lag": _feed_lag(""),
        "feed_lag_percentiles": """
WITH timed AS (SELECT ts, CAST(round(value * 1000) AS BIGINT) AS behind FROM events)
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
  quantile_disc(behind, 0.5) AS p50_ms, quantile_disc(behind, 0.95) AS p95_ms,
  quantile_disc(behind, 0.99) AS p99_ms FROM timed GROUP BY 1""",
        "stream_lag_percentiles": """
SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start,
  time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end, count(*) AS events,
  true AS p50_near, true AS p95_near, true AS p99_near FROM events GROUP BY 1""",
        "mirror_deliveries": raw
        + f"""SELECT CAST({sum(MIRROR_FILES)} AS BIGINT) AS batches, CAST(0 AS BIGINT) AS missing_batches,
  count(*) AS read_rows, count(*) AS delivered_rows,
  CAST(0 AS BIGINT) AS repeats_cut FROM raw""",
        "mirror": raw
        + "SELECT id AS message_key, 'source=web' AS headers, id, api_version, collection, current_url, "
        "device_id, user_id_db, resolution, email_address, ip, local_time, option, product_id, "
        "referrer_url, store_id, time_stamp, user_agent FROM raw",
    }
    statements["ip_geolocate_distinct"] = statements["ip_geolocate"]
    return {name: statement.strip() for name, statement in statements.items()}
