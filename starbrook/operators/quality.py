"""Data-quality checks. Each returns a table and passes over the tables it reads once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.schemas import FACT_REFERENCES, STAR_TABLES, TEXT, columns


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def column_nulls(df: DataFrame, table: str) -> DataFrame:
    """Rows and nulls per column: one aggregate for all columns, then one row per column."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in df.columns),
    )
    cells = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in df.columns)
    )
    return counts.select(
        F.lit(table).alias("table_name"), F.col("_rows").alias("total_rows"), F.explode(cells).alias("c")
    ).select("table_name", "total_rows", "c.column_name", "c.null_count")


def completeness(tables: dict[str, DataFrame]) -> DataFrame:
    """Share of non-null cells per table, graded ok (from 90), warn (from 70) or fail."""
    nulls = _union([column_nulls(df, name) for name, df in tables.items()])
    return graded(
        nulls.groupBy("table_name").agg(
            F.max("total_rows").alias("total_rows"),
            F.count(F.lit(1)).alias("columns"),
            F.sum("null_count").alias("null_cells"),
        )
    )


def graded(counts: DataFrame) -> DataFrame:
    """Adds the share of non-null cells and its grade to ``total_rows``, ``columns``, ``null_cells``."""
    cells = F.greatest(F.col("total_rows") * F.col("columns"), F.lit(1))
    pct = F.bround((1 - F.col("null_cells") / cells) * 100, 2)
    return counts.withColumn("completeness_pct", pct).withColumn(
        "grade",
        F.when(F.col("completeness_pct") >= 90, "ok")
        .when(F.col("completeness_pct") >= 70, "warn")
        .otherwise("fail"),
    )


def schema_check(tables: dict[str, DataFrame]) -> DataFrame:
    """Declared against actual columns, with the nulls found where none are allowed."""
    spark = next(iter(tables.values())).sparkSession
    rows, nulls = [], []
    for name, df in tables.items():
        declared = {f.name: f for f in STAR_TABLES[name].fields}
        actual = {f.name: f for f in df.schema.fields}
        for position, column in enumerate([*declared, *(c for c in actual if c not in declared)]):
            want, have = declared.get(column), actual.get(column)
            rows.append(
                (
                    name,
                    position + 1,
                    column,
                    want.dataType.simpleString() if want else None,
                    have.dataType.simpleString() if have else None,
                    want.nullable if want else None,
                )
            )
        required = [c for c in declared if not declared[c].nullable and c in actual]
        if required:
            nulls.append(column_nulls(df.select(*required), name))
    listing = spark.createDataFrame(
        rows,
        "table_name STRING, position INT, column_name STRING, expected_type STRING, "
        "actual_type STRING, nullable BOOLEAN",
    )
    found = _union(nulls).select("table_name", "column_name", "null_count")
    status = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "unexpected")
        .when(F.col("expected_type") != F.col("actual_type"), "type_mismatch")
        .when(F.col("null_count") > 0, "null_violation")
        .otherwise("ok")
    )
    return listing.join(found, ["table_name", "column_name"], "left").withColumn("status", status)


def key_usage(fact: DataFrame, key: str) -> DataFrame:
    """Rows per key value: counted before any shuffle, so a hot key is one row per task."""
    return fact.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, check: str) -> DataFrame:
    """Fact rows whose key is not in the dimension, and, separately, rows without a key."""
    usage = key_usage(fact, fact_key)
    known = dim.select(F.col(dim_key).alias(fact_key)).withColumn("known", F.lit(True))
    has_key = F.col(fact_key).isNotNull()
    judged = usage.join(known, fact_key, "left")
    return judged.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(has_key & F.col("known").isNull(), F.col("rows"))), F.lit(0)).alias(
            "orphan_rows"
        ),
        F.count(F.when(has_key & F.col("known").isNull(), 1)).alias("orphan_keys"),
        F.coalesce(F.sum(F.when(~has_key, F.col("rows"))), F.lit(0)).alias("null_rows"),
    ).select(F.lit(check).alias("check_name"), "*")


def _named(reference: str, key: Column) -> tuple[Column, Column]:
    return F.lit(reference).alias("reference"), key.cast("bigint").alias("key")


def reference_counts(tables: dict[str, DataFrame], fact_table: str) -> DataFrame:
    """For every reference of the fact, and its own primary key: rows, rows and keys without a
    member, and rows without a key.

    One pass over the fact: all references of a row are counted by (reference, key) before the
    shuffle, so a hot key is one row per task, and the counts meet all dimensions in one join.
    """
    return judge_usage(reference_usage(tables[fact_table], fact_table), tables, fact_table)


def reference_usage(fact: DataFrame, fact_table: str) -> DataFrame:
    """Rows by reference and key; of the primary key only its presence counts, as key 0."""
    primary = STAR_TABLES[fact_table].fieldNames()[0]
    present = F.when(F.col(primary).isNotNull(), F.lit(0))
    keys = [F.struct(*_named(k, F.col(k))) for k in FACT_REFERENCES]
    keys.append(F.struct(*_named(primary, present)))
    return (
        fact.select(F.inline(F.array(*keys)))
        .groupBy("reference", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def judge_usage(usage: DataFrame, tables: dict[str, DataFrame], fact_table: str) -> DataFrame:
    """Compares ``reference_usage`` with the keys of the dimensions in ``tables``."""
    spark, primary = usage.sparkSession, STAR_TABLES[fact_table].fieldNames()[0]
    members = [
        tables[dim].select(*_named(k, F.col(dim_key))) for k, (dim, dim_key) in FACT_REFERENCES.items()
    ]
    members.append(spark.range(1).select(*_named(primary, F.col("id"))))
    known = _union(members).withColumn("known", F.lit(True))
    has_key = F.col("key").isNotNull()
    missing = has_key & F.col("known").isNull()
    counted = (
        usage.join(known, ["reference", "key"], "left")
        .groupBy("reference")
        .agg(
            F.sum("rows").alias("total_rows"),
            F.sum(F.when(missing, F.col("rows"))).alias("orphan_rows"),
            F.count(F.when(missing, 1)).alias("orphan_keys"),
            F.sum(F.when(~has_key, F.col("rows"))).alias("null_rows"),
        )
    )
    listed = spark.createDataFrame([(k,) for k in (*FACT_REFERENCES, primary)], "reference string")
    sums = ["total_rows", "orphan_rows", "orphan_keys", "null_rows"]
    # seven rows
    return listed.join(F.broadcast(counted), "reference", "left").select(
        "reference", *(F.coalesce(c, F.lit(0)).alias(c) for c in sums)
    )


def _check_names(prefix: str) -> Column:
    pairs = [F.lit(x) for k, (dim, _) in FACT_REFERENCES.items() for x in (k, prefix + dim.removeprefix("dim_"))]
    return F.create_map(*pairs)[F.col("reference")]


def orphan_report(tables: dict[str, DataFrame], fact_table: str = "fact_product_views") -> DataFrame:
    """Fact rows whose key is not in its dimension, and, separately, rows without a key."""
    named = reference_counts(tables, fact_table).withColumn("check_name", _check_names("no_orphan_"))
    return named.filter("check_name is not null").select(
        "check_name", "total_rows", "orphan_rows", "orphan_keys", "null_rows"
    )


def duplicates(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """Rows beyond the first per key; a row with a null key part counts as surplus, as in SQL."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    complete = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return (
        counted.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
            F.count(F.when(complete, 1)).alias("distinct_keys"),
        )
        .select(F.lit(table).alias("table_name"), "*")
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_keys"))
    )


def error_rate(
    tables: dict[str, DataFrame], expected_min: int = 0, fact_table: str = "fact_product_views"
) -> DataFrame:
    """Null primary keys per table, unmatched references of the fact, and the minimum row count."""
    null_keys = []
    for name, df in tables.items():
        if name != fact_table:
            key = STAR_TABLES[name].fieldNames()[0]
            null_keys.append(
                df.agg(
                    F.count(F.lit(1)).alias("total_rows"),
                    F.count(F.when(F.col(key).isNull(), 1)).alias("error_rows"),
                ).select(F.lit(name).alias("table_name"), F.lit("null_key").alias("check_name"), "*")
            )
    return error_shares(_union(null_keys), reference_counts(tables, fact_table), expected_min, fact_table)


def error_shares(
    null_keys: DataFrame, references: DataFrame, expected_min: int, fact_table: str
) -> DataFrame:
    """The rows of ``error_rate`` from null keys by table and the counts of the fact's references."""
    references = references.select(
        F.lit(fact_table).alias("table_name"),
        F.coalesce(_check_names("missing_"), F.lit("null_key")).alias("check_name"),
        "total_rows",
        (F.col("orphan_rows") + F.col("null_rows")).alias("error_rows"),
    )
    share = F.bround(F.col("error_rows") / F.greatest("total_rows", F.lit(1)) * 100, 2)
    return (
        null_keys.unionByName(references)
        .withColumn("error_pct", share)
        .withColumn("meets_minimum", F.col("total_rows") >= expected_min)
    )


# of a statement that cannot be analysed, and of one whose job fails
STATEMENT_ERRORS = (PySparkException, Py4JJavaError)


class QualityError(ValueError):
    """At least one expectation was not met."""


EXPECTATION_RESULT = columns(name=TEXT, expected=TEXT, actual=TEXT, status=TEXT, error=TEXT)


def run_expectations(
    spark: SparkSession, checks: Sequence[dict], raise_on_fail: bool = False
) -> DataFrame:
    """Compares the first value of each statement with what is expected.

    Statements are analysed one by one and those that can be run are run side by side, as scalar
    subqueries of one query; only if that fails is each run for itself, to find which ones do. All
    checks run before anything is raised; one that errors, or returns no row, has failed. Only one
    value per check reaches the driver.
    """
    problems, valid = {}, {}
    for place, check in enumerate(checks):
        try:
            valid[place] = _first_value(spark.sql(check["sql"]))
        except STATEMENT_ERRORS as problem:
            problems[place] = problem
    found = {}
    try:
        found = _side_by_side(spark, valid)
    except STATEMENT_ERRORS:
        for place, frame in valid.items():
            try:
                found |= _side_by_side(spark, {place: frame})
            except STATEMENT_ERRORS as problem:
                problems[place] = problem
    results = []
    for place, check in enumerate(checks):
        name, expected = check.get("name", check["sql"]), check.get("expected_result")
        if place in problems:
            problem = getattr(problems[place], "java_exception", problems[place])
            actual, status, error = None, "error", str(problem).splitlines()[0]
        else:
            count, actual = found[place]
            status, error = "passed" if count and actual == expected else "failed", None
        shown = [None if v is None else str(v) for v in (expected, actual)]
        results.append((name, *shown, status, error))
    bad = [r for r in results if r[3] != "passed"]
    if bad and raise_on_fail:
        lines = [f"{r[0]}: {r[3]}, expected {r[1]}, got {r[2]} {r[4] or ''}".rstrip() for r in bad]
        raise QualityError("Data quality checks not met:\n" + "\n".join(lines))
    return spark.createDataFrame(results, EXPECTATION_RESULT)


def _first_value(df: DataFrame) -> DataFrame:
    """One row with whether there is a first row, and its first value."""
    first = df.toDF(*(f"c{i}" for i in range(len(df.columns)))).limit(1)
    value = F.struct(F.count(F.lit(1)).alias("n"), F.first("c0").alias("v"))
    return first.agg(value.alias("found"))


def _side_by_side(spark: SparkSession, frames: dict[int, DataFrame]) -> dict[int, tuple]:
    """The single values of frames of one row, by one query."""
    if not frames:
        return {}
    row = spark.range(1).select(*(f.scalar().alias(f"v{place}") for place, f in frames.items())).first()
    return {place: tuple(row[f"v{place}"]) for place in frames}


# The rules every star schema must meet, over the views of Warehouse.register_views().
BUSINESS_RULES = [
    {
        "name": f"no_orphan_{name}",
        "sql": (
            "SELECT count(*) FROM "
            f"(SELECT DISTINCT {key} FROM fact_product_views WHERE {key} IS NOT NULL) f "
            f"LEFT ANTI JOIN dim_{name} d ON f.{key} = d.{key}"
        ),
        "expected_result": 0,
    }
    for name, key in (("customer", "customer_key"), ("product", "product_key"))
] + [
    {
        "name": "no_duplicate_events",
        "sql": "SELECT count(*) - count(DISTINCT fact_id) FROM fact_product_views",
        "expected_result": 0,
    }
]


def quality_report(
    tables: dict[str, DataFrame], expectations: DataFrame, expected_min: int = 0
) -> DataFrame:
    """All checks as (section, name, passed), followed by the overall status."""

    def section(df: DataFrame, label: str, name: Column, passed: Column) -> DataFrame:
        return df.select(
            F.lit(label).alias("section"), name.alias("name"), passed.alias("passed")
        )

    errors = error_rate(tables, expected_min)
    parts = [
        section(
            completeness(tables), "completeness", F.col("table_name"), F.col("grade") != "fail"
        ),
        section(
            schema_check(tables).groupBy("table_name").agg(
                F.min((F.col("status") == "ok").cast("int")).alias("ok")
            ),
            "schema",
            F.col("table_name"),
            F.col("ok") == 1,
        ),
        section(
            errors.filter(F.col("check_name") == "null_key"),
            "error_rate",
            F.col("table_name"),
            (F.col("error_rows") == 0) & F.col("meets_minimum"),
        ),
        section(expectations, "expectation", F.col("name"), F.col("status") == "passed"),
    ]
    checks = _union(parts)
    overall = checks.agg(F.min(F.col("passed").cast("int")).alias("ok")).select(
        F.lit("overall").alias("section"),
        F.when(F.col("ok") == 1, "HEALTHY").otherwise("DEGRADED").alias("name"),
        (F.col("ok") == 1).alias("passed"),
    )
    return checks.unionByName(overall)
