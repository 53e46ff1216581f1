"""Relational source and sink over Spark's JDBC connector; the driver jar is the user's choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per insert statement.
INSERT_PAGE = 500


def postgres_url(host: str, port: int | str, database: str) -> str:
    return f"jdbc:postgresql://{host}:{port}/{database}"


def read_options(
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    **more: str,
) -> dict[str, str]:
    """With a partition column the table is read by many tasks, else by one."""
    options = {"url": url, "dbtable": table, **more}
    if partition_column:
        if not bounds or not partitions:
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(partitions),
        )
    return options


def read_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = INSERT_PAGE,
    connections: int | None = None,
    **options: str,
) -> None:
    """Each partition inserts over its own connection; ``connections`` bounds how many at once."""
    settings = {"url": url, "dbtable": table, "batchsize": str(batch_size), **options}
    if connections:
        settings["numPartitions"] = str(connections)
    df.write.format("jdbc").mode(mode).options(**settings).save()
