"""Quality figures that add up, kept as each batch is written, so that checks need not read the fact.

A batch leaves, per table (for the fact per day), its rows and the nulls of each column, and per
reference of the fact how many of its rows hold each key. A new version of a customer comes with the
counts of the version it replaces, negative. Sums over the visible batches are the figures of whole
tables: a batch that never succeeded is not visible, and one that is repeated is not written again.

The figures are of what was loaded; facts archived later stay counted. A fact without a time has no day.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.operators import quality
from starbrook.schemas import STAR_TABLES

FACT = "fact_product_views"
ROWS, NULLS, KEYS = "rows", "nulls", "keys"


def column_counts(df: DataFrame, table: str, day: Column | None = None, sign: int = 1) -> DataFrame:
    """Rows, and nulls of each declared column, by day; one pass, and counts are combined before they
    are shuffled."""
    names = STAR_TABLES[table].fieldNames()
    by = F.lit(None).cast("int") if day is None else day
    counts = df.groupBy(by.alias("_day")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *(F.count(F.when(F.col(c).isNull(), 1)).alias(f"_{i}") for i, c in enumerate(names)),
    )

    def cell(metric: str, name: str | None, n: str) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), F.lit(name).cast("string").alias("name"), F.col(n).alias("n")
        )

    cells = F.array(cell(ROWS, None, "_rows"), *(cell(NULLS, c, f"_{i}") for i, c in enumerate(names)))
    return counts.select(F.col("_day").alias("day"), F.inline(cells)).select(
        F.lit(table).alias("table_name"),
        "metric",
        "name",
        F.lit(None).cast("bigint").alias("key"),
        "day",
        (F.col("n") * sign).alias("n"),
    )


def key_counts(fact: DataFrame) -> DataFrame:
    """Rows per reference of the fact and key."""
    return quality.reference_usage(fact, FACT).select(
        F.lit(FACT).alias("table_name"),
        F.lit(KEYS).alias("metric"),
        F.col("reference").alias("name"),
        "key",
        F.lit(None).cast("int").alias("day"),
        F.col("rows").alias("n"),
    )


def batch_counts(tables: dict[str, DataFrame], replaced: DataFrame | None = None) -> DataFrame:
    """Counts of one batch: what it wrote to each table, and the customers that it gave new versions,
    as they were before."""
    parts = [column_counts(df, name) for name, df in tables.items() if name != FACT]
    if replaced is not None:
        parts.append(column_counts(replaced, "dim_customer", sign=-1))
    if FACT in tables:
        parts += [column_counts(tables[FACT], FACT, F.col("date_id")), key_counts(tables[FACT])]
    return reduce(DataFrame.unionByName, parts)


def _totals(kept: DataFrame, *by: str) -> list[Column]:
    n = F.col("n")
    return [
        F.coalesce(F.sum(F.when(F.col("metric") == ROWS, n)), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("metric") == NULLS, n)), F.lit(0)).alias("null_cells"),
    ]


def _declared(spark: SparkSession) -> DataFrame:
    rows = [(name, len(schema), schema.fieldNames()[0]) for name, schema in STAR_TABLES.items()]
    return spark.createDataFrame(rows, "table_name string, columns bigint, name string")


def completeness(kept: DataFrame) -> DataFrame:
    """``quality.completeness`` of all tables of the star schema, from kept counts alone."""
    sums = kept.filter(F.col("metric") != KEYS).groupBy("table_name").agg(*_totals(kept))
    per_table = _declared(kept.sparkSession).join(F.broadcast(sums), "table_name", "left")  # seven rows
    return quality.graded(
        per_table.select(
            "table_name",
            F.coalesce("total_rows", F.lit(0)).alias("total_rows"),
            "columns",
            F.coalesce("null_cells", F.lit(0)).alias("null_cells"),
        )
    )


def completeness_by_day(kept: DataFrame) -> DataFrame:
    """Completeness of the facts of each day that has any; the day is null for facts without a time."""
    facts = kept.filter((F.col("table_name") == FACT) & (F.col("metric") != KEYS))
    per_day = facts.groupBy(F.col("day").alias("date_id")).agg(*_totals(kept))
    width = F.lit(len(STAR_TABLES[FACT])).cast("bigint")
    return quality.graded(
        per_day.filter(F.col("total_rows") > 0).select("date_id", "total_rows", width.alias("columns"), "null_cells")
    )


def error_rate(kept: DataFrame, tables: dict[str, DataFrame], expected_min: int = 0) -> DataFrame:
    """``quality.error_rate`` from kept counts and the keys in ``tables``; the fact is not read.

    The counts of a key from all batches are added before they meet the dimensions.
    """
    own = F.col("metric").isin(ROWS, NULLS) & (F.col("table_name") != FACT)
    primary = _declared(kept.sparkSession).filter(F.col("table_name") != FACT).select("table_name", "name")
    is_key = (F.col("metric") == NULLS) & (F.col("name") == F.col("_primary"))
    counted = (
        kept.filter(own)
        .join(F.broadcast(primary.withColumnRenamed("name", "_primary")), "table_name")  # six rows
        .groupBy("table_name")
        .agg(
            F.sum(F.when(F.col("metric") == ROWS, F.col("n"))).alias("total_rows"),
            F.sum(F.when(is_key, F.col("n"))).alias("error_rows"),
        )
    )
    null_keys = primary.join(F.broadcast(counted), "table_name", "left").select(
        "table_name",
        F.lit("null_key").alias("check_name"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total_rows", "error_rows")),
    )
    usage = (
        kept.filter(F.col("metric") == KEYS)
        .groupBy(F.col("name").alias("reference"), "key")
        .agg(F.sum("n").alias("rows"))
    )
    references = quality.judge_usage(usage, tables, FACT)
    return quality.error_shares(null_keys, references, expected_min, FACT)
