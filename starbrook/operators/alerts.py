"""Alert rules over table metrics.

Each metric is a one-row aggregate in the shape of ``METRIC_SCHEMA``; rules are matched to metrics by
check type and table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbrook.operators.quality import duplicates
from starbrook.schemas import REAL, TEXT, WHOLE, columns
from starbrook.sources.warehouse import FACT

RULE_SCHEMA = columns(
    rule_order=WHOLE,
    name=TEXT,
    description=TEXT,
    severity=TEXT,
    check_type=TEXT,
    table_name=TEXT,
    threshold=REAL,
    max_delay_minutes=WHOLE,
)

# Names, texts, severities and limits of the standing rules.
ALERT_RULES = [
    {
        "name": "fact_table_empty",
        "description": "Fact table has no data",
        "severity": "HIGH",
        "check_type": "table_count",
        "table_name": FACT,
        "threshold": 0.0,
    },
    {
        "name": "low_data_quality",
        "description": "Data quality check found issues",
        "severity": "MEDIUM",
        "check_type": "data_quality",
        "table_name": FACT,
        "threshold": 0.0,
    },
    {
        "name": "high_storage_usage",
        "description": "Database storage is growing unusually",
        "severity": "LOW",
        "check_type": "storage_check",
        "table_name": FACT,
        "threshold": 1.5,
    },
    {
        "name": "dag_failure_detected",
        "description": "One or more DAGs failed recently",
        "severity": "CRITICAL",
        "check_type": "dag_failure",
        "table_name": "run_log",
        "threshold": 0.0,
    },
    {
        "name": "data_stagnation",
        "description": "Spark streaming data freshness check",
        "severity": "HIGH",
        "check_type": "data_freshness",
        "table_name": FACT,
        "max_delay_minutes": 10,
    },
]
# fixed values: severities and their priorities
SEVERITY_PRIORITY = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4}
UNKNOWN_PRIORITY = 5
FAILURE_WINDOW_MINUTES = 15

METRIC_SCHEMA = columns(
    check_type=TEXT,
    table_name=TEXT,
    value=T.DoubleType(),
    latest=T.TimestampType(),
    names=T.ArrayType(T.StringType()),
    minutes=T.IntegerType(),
)
_METRIC = METRIC_SCHEMA.fieldNames()


def rules_frame(spark: SparkSession, rules: Sequence[dict] = ALERT_RULES) -> DataFrame:
    names = RULE_SCHEMA.fieldNames()[1:]
    rows = [(i, *(rule.get(n) for n in names)) for i, rule in enumerate(rules)]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _metric(df: DataFrame, check: str, table: str, **values: Column) -> DataFrame:
    defaults = {
        "value": F.lit(None).cast("double"),
        "latest": F.lit(None).cast("timestamp"),
        "names": F.lit(None).cast("array<string>"),
        "minutes": F.lit(None).cast("int"),
    }
    given = {**defaults, **values}
    return df.select(
        F.lit(check).alias("check_type"),
        F.lit(table).alias("table_name"),
        given["value"].cast("double").alias("value"),
        given["latest"].alias("latest"),
        given["names"].alias("names"),
        given["minutes"].alias("minutes"),
    )


def count_and_freshness(df: DataFrame, table: str, time_column: str = "time_stamp") -> DataFrame:
    """Row count and newest time of a table, in one pass."""
    both = df.agg(F.count(F.lit(1)).alias("n"), F.max(time_column).alias("t"))
    pair = F.array(
        F.struct(
            F.lit("table_count").alias("check"),
            F.col("n").cast("double").alias("value"),
            F.lit(None).cast("timestamp").alias("latest"),
        ),
        F.struct(
            F.lit("data_freshness").alias("check"),
            F.lit(None).cast("double").alias("value"),
            F.col("t").alias("latest"),
        ),
    )
    return both.select(F.explode(pair).alias("m")).select(
        F.col("m.check").alias("check_type"),
        F.lit(table).alias("table_name"),
        "m.value",
        "m.latest",
        F.lit(None).cast("array<string>").alias("names"),
        F.lit(None).cast("int").alias("minutes"),
    )


def duplicate_metric(df: DataFrame, table: str, key: str = "fact_id") -> DataFrame:
    surplus = duplicates(df, [key], table)
    return _metric(surplus, "data_quality", table, value=F.col("duplicate_rows"))


def failed_jobs(
    runs: DataFrame, as_of: Column, minutes: int = FAILURE_WINDOW_MINUTES
) -> DataFrame:
    """Jobs with a failed run that ended within the window, with the number of failures."""
    since = as_of - F.make_interval(mins=F.lit(minutes))
    recent = runs.filter((F.col("state") == "failed") & (F.col("end_date") >= since))
    return recent.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("failed_runs"), F.max("end_date").alias("last_failure")
    )


def failed_job_metric(
    runs: DataFrame, as_of: Column, table: str = "run_log", minutes: int = FAILURE_WINDOW_MINUTES
) -> DataFrame:
    """Number and sorted names of failed jobs; there are as many as scheduled jobs, not runs."""
    jobs = failed_jobs(runs, as_of, minutes).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("job_id")).alias("ids")
    )
    window = F.lit(minutes)
    return _metric(jobs, "dag_failure", table, value=F.col("n"), names=F.col("ids"), minutes=window)


def storage_metric(current: DataFrame, previous: DataFrame, table: str) -> DataFrame:
    """Growth of a table's bytes between two footprints (see retention.table_footprint)."""

    def size(df: DataFrame, name: str) -> DataFrame:
        return df.filter(F.col("table_name") == table).select(
            "table_name", F.col("bytes").alias(name)
        )

    both = size(current, "now").join(size(previous, "then"), "table_name")
    ratio = F.when(F.col("then") > 0, F.col("now") / F.col("then"))
    return _metric(both, "storage_check", table, value=ratio)


def _triggered(as_of: Column) -> Column:
    value, limit = F.col("value"), F.coalesce("threshold", F.lit(0.0))
    delay = F.make_interval(mins=F.coalesce("max_delay_minutes", F.lit(15)))
    kind = F.col("check_type")
    return (
        F.when(kind == "table_count", value <= limit)
        .when(kind == "data_freshness", F.col("latest") < as_of - delay)
        .when(kind.isin("data_quality", "dag_failure", "storage_check"), value > limit)
        .otherwise(F.lit(False))
    )


def _description() -> Column:
    kind = F.col("check_type")
    stuck = F.format_string(
        "Streaming stuck: No new data in %s since %s (>%d mins delay)",
        F.col("table_name"),
        F.date_format("latest", "HH:mm:ss"),
        F.coalesce("max_delay_minutes", F.lit(15)),
    )
    failed = F.concat(
        F.lit("Failed DAGs detected in the last "),
        F.col("minutes").cast("string"),
        F.lit(" mins: "),
        F.array_join("names", ", "),
    )
    return (
        F.when(kind == "data_freshness", stuck)
        .when(kind == "dag_failure", failed)
        .otherwise(F.col("description"))
    )


def priority(severity: Column) -> Column:
    ranked = F.when(F.lit(False), F.lit(UNKNOWN_PRIORITY))
    for name, rank in SEVERITY_PRIORITY.items():
        ranked = ranked.when(severity == name, F.lit(rank))
    return ranked.otherwise(F.lit(UNKNOWN_PRIORITY))


@dataclass(frozen=True)
class Measure:
    """One metric of a table as an aggregate over its rows: a number, or a time."""

    check_type: str
    value: Column | None = None
    latest: Column | None = None


def row_count() -> Measure:
    return Measure("table_count", value=F.count(F.lit(1)))


def freshness(time_column: str) -> Measure:
    return Measure("data_freshness", latest=F.max(time_column))


def surplus(key: str) -> Measure:
    """Rows beyond one for each key; a null key counts as surplus."""
    return Measure("data_quality", value=F.count(F.lit(1)) - F.count_distinct(key))


def measure(
    spark: SparkSession,
    tables: dict[str, tuple[DataFrame, Sequence[Measure]]],
    derived: Sequence[tuple[str, str, Callable[[], DataFrame]]] = (),
) -> tuple[DataFrame, DataFrame]:
    """All metrics of a table in one aggregate, so each table is scanned once, and ``derived`` ones
    (check type, table, metric in the shape of ``METRIC_SCHEMA``) that need more than one table.

    Every metric is analysed for itself before anything runs, so a missing table or column costs only
    its own check. Returns the metrics, and (``check_type``, ``table_name``, ``error``) of the checks
    that cannot be analysed. An error while they run is raised: it says nothing about a check.
    """
    rows, failed, frames = [], [], []
    for table, (df, measures) in tables.items():
        sound = []
        for m in measures:
            number = F.lit(None) if m.value is None else m.value
            time = F.lit(None) if m.latest is None else m.latest
            found = F.struct(
                F.lit(m.check_type).alias("check_type"),
                F.lit(table).alias("table_name"),
                number.cast("double").alias("value"),
                time.cast("timestamp").alias("latest"),
                F.lit(None).cast("array<string>").alias("names"),
                F.lit(None).cast("int").alias("minutes"),
            )
            try:
                df.agg(found)
            except AnalysisException as error:
                failed.append((m.check_type, table, str(error)))
            else:
                sound.append(found.alias(f"m{len(sound)}"))
        if sound:
            frames.append(df.agg(*sound))
    for kind, table, metric in derived:
        try:
            frames.append(metric().select(F.struct(*_METRIC).alias("m0")))
        except AnalysisException as error:
            failed.append((kind, table, str(error)))
    # the tables do not depend on each other
    with ThreadPoolExecutor(max(1, len(frames))) as pool:
        runs = [pool.submit(inheritable_thread_target(spark)(frame.collect)) for frame in frames]
        for run in runs:
            rows.extend(tuple(m) for row in run.result() for m in row)
    failures = columns(check_type=TEXT, table_name=TEXT, error=TEXT)
    return spark.createDataFrame(rows, METRIC_SCHEMA), spark.createDataFrame(failed, failures)


def skipped_rules(rules: DataFrame, failures: DataFrame) -> DataFrame:
    """Rules that could not be evaluated, with the reason."""
    return rules.join(failures, ["check_type", "table_name"]).select("name", "severity", "error")


def evaluate_rules(rules: DataFrame, metrics: Sequence[DataFrame], as_of: Column) -> DataFrame:
    """Triggered alerts, most severe first; a rule without a metric, or with a null one, is quiet."""
    measured = reduce(DataFrame.unionByName, [m.select(*_METRIC) for m in metrics])
    return (
        rules.join(measured, ["check_type", "table_name"])
        .filter(_triggered(as_of))
        .select(
            "name",
            _description().alias("description"),
            "severity",
            priority(F.col("severity")).alias("priority"),
            as_of.alias("triggered_at"),
            "rule_order",
        )
        .orderBy("priority", "rule_order")
    )


def classify(alerts: DataFrame) -> DataFrame:
    """Alerts with their place within their severity; there are at most as many as rules."""
    place = W.partitionBy("severity").orderBy("rule_order")
    return alerts.withColumn("place", F.row_number().over(place))


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Counts per severity, and whether any critical alert asks for escalation."""
    counts = [
        F.count(F.when(F.col("severity") == name, 1)).alias(name.lower())
        for name in SEVERITY_PRIORITY
    ]
    return alerts.agg(F.count(F.lit(1)).alias("total"), *counts).withColumn(
        "requires_escalation", F.col("critical") > 0
    )
