"""What the operators of this package share: the columns they read, and held-out rows."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import starbrook
from starbrook.session import cut_lineage, scratch_path

WHITE_SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# Texts handed to one vectorised step, in characters; a longer text is a step of its own.
STEP_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BATCH_BYTES = 4 << 20


def prepare_workers(spark: SparkSession) -> None:
    """Batches handed to Python are bounded by bytes, so that long texts do not make large ones, and
    workers look for this package where the driver has it, too. On a cluster it is installed there
    or named in ``--py-files``."""
    given = spark.conf.get(BATCH_BYTES).rstrip("b")
    if not given.isdigit() or int(given) > MOST_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, str(MOST_BATCH_BYTES))
    environment, root = spark.sparkContext.environment, str(Path(starbrook.__file__).parents[1])
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the whole text, null read as empty. Other columns are left behind, so that
    columns of any name may accompany them."""
    prepare_workers(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def training_fold() -> Column:
    """True for rows whose labels may be learned from: crc32 of the id as text, mod 5, not 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 0, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents in the order of a hash of their ids: ``doc_id``, ``label``.

    A document labelled more than once counts once, with its largest label.
    """
    known = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).filter("doc_id is not null and label in (0, 1)")
    once = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def steps(ids: pa.Array, texts: pa.Array) -> Iterator[tuple[list, list[str]]]:
    """Rows of an Arrow batch in steps of bounded text, so that memory follows the longest text."""
    lengths = pc.binary_length(texts).to_pylist()
    start = held = 0
    for i, length in enumerate(lengths):
        if i > start and held + length > STEP_CHARS:
            yield ids.slice(start, i - start).to_pylist(), texts.slice(start, i - start).to_pylist()
            start, held = i, 0
        held += length
    if start < len(lengths):
        yield ids.slice(start).to_pylist(), texts.slice(start).to_pylist()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage is cut as by a checkpoint,
    and tables of many short strings take a fraction of its space."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1_000_000


def counted(keys: DataFrame) -> DataFrame:
    """Keys of a few bytes each, written once, and broadcast up to a counted bound so that the texts
    they are joined with stay where they are; beyond it both sides are shuffled."""
    keys = cut_lineage(keys)
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def without(docs: DataFrame, key: list[Column], going: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose key is not among the rows of ``going``, with all their columns."""
    names = [f"k{i}" for i in range(len(key))]
    going = counted(going.toDF(*names).distinct())
    rows = docs.select(*(k.alias(n) for k, n in zip(key, names, strict=True)), F.struct("*").alias("row"))
    same = [rows[n].eqNullSafe(going[n]) for n in names]
    return rows.join(going, same, "left_anti").select("row.*")
