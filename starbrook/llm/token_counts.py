"""Token counts by source, language and tokenizer version, kept up by deltas.

A batch of changes becomes signed rows: an insert adds a document's count, a delete takes away what
is on record, and a revision does both. The signed rows are kept by document, and their sums by
group are the batch's rollup. Totals are the sum of the rollups of committed batches, so they follow
from small tables however many documents there are.

A batch is written to a folder of its own under an attempt number, and a commit row that names the
attempt makes it visible. Committing a batch number again changes nothing; an attempt that broke off
is never read. Signed rows lie in a fixed number of parts by a hash of the document id; a batch reads
the parts it touches and joins them with its own documents, so documents that do not change are not
shuffled. ``fold`` sums the signed rows of all batches into one folder, again seen by a row that names
it, so that neither history nor the number of folders grows with revisions.

A root has one writer at a time: batches and folds follow one another. Readers may run beside it; they
see the batches committed when they began.

Defined results: a null text has no tokens. Source and language may be null and form groups of their
own. Of several changes to a document in a batch, the one of the largest ``seq`` counts, then delete,
revise, insert in this order, then the larger count. An insert of a document on record revises it; a
revision of one not on record inserts it; a delete of one not on record changes nothing. Changes
without a document id are left out. Groups without documents are not listed. An empty batch commits
an empty rollup. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from starbrook.llm.bpe import Ranks
from starbrook.llm.common import WORD, counted, prepare_workers, table
from starbrook.llm.packing import VOCABULARY, Tokens, _shared
from starbrook.session import cut_lineage, scratch_path

INSERT, REVISE, DELETE = "insert", "revise", "delete"
BPE, WORDS = "byte_bpe_50k/1", "words/1"

COUNTS = "doc_id bigint, source string, lang string, seq bigint, kind string, tokens bigint, words bigint"
PARTS = 64  # of the signed rows; about one for every gigabyte of them
SIGNED = "doc_id bigint, source string, lang string, tokenizer string, docs bigint, tokens bigint"
ROLLUP = "source string, lang string, tokenizer string, docs bigint, tokens bigint"


def count_tokens(changes: DataFrame, ranks: Ranks) -> DataFrame:
    """The changes with counts in place of texts; deletes are not counted."""
    prepare_workers(changes.sparkSession)
    shared = changes.sparkSession.sparkContext.broadcast(ranks)  # size of the vocabulary
    text = F.when(F.col("kind") != DELETE, F.col("text").cast("string"))
    rows = changes.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.col("seq").cast("bigint").alias("seq"),
        "kind",
        F.coalesce(text, F.lit("")).alias("text"),
    ).filter("doc_id is not null")
    with_words = rows.withColumn("words", F.regexp_count("text", F.lit(WORD)).cast("bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Tokens = _shared(shared)
        for batch in batches:
            tokens = pa.array([len(own.ids(t.as_py())) for t in batch["text"]], pa.int64())
            kept = [batch[c] for c in ("doc_id", "source", "lang", "seq", "kind")]
            yield pa.RecordBatch.from_arrays(
                [*kept, tokens, batch["words"]], ["doc_id", "source", "lang", "seq", "kind", "tokens", "words"]
            )

    return with_words.mapInArrow(run, COUNTS)


class Rollup:
    """Token counts in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, root: str, ranks: Ranks, parts: int = PARTS):
        """``parts`` belongs to the root and stays as it was when the first batch was committed."""
        self.spark, self.root, self.ranks, self.parts = spark, root, ranks, parts

    def _rows(self, path: str, schema: str) -> list[Row]:
        """Small rows, one a folder; none if there is no folder yet."""
        try:
            return self.spark.read.schema(schema).parquet(path).collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _commits(self) -> dict[int, str]:
        """Attempt by batch; one small row a batch."""
        rows = self._rows(f"{self.root}/commits/*", "batch bigint, attempt string")
        return {r["batch"]: r["attempt"] for r in rows}

    def _newest_fold(self) -> Row | None:
        rows = self._rows(f"{self.root}/folds/*", "number bigint, attempt string, batches array<bigint>")
        return max(rows, key=lambda r: r["number"], default=None)

    def _read(self, kind: str, schema: str) -> DataFrame:
        """The newest fold's rows, and those of the batches committed since."""
        fold = self._newest_fold()
        folded = set(fold["batches"]) if fold else set()
        attempts = [fold["attempt"]] if fold else []
        attempts += [f"{b}-{a}" for b, a in sorted(self._commits().items()) if b not in folded]
        if not attempts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{kind}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*(f"{base}/attempt={a}" for a in attempts))

    def _part(self) -> Column:
        return F.pmod(F.xxhash64("doc_id"), F.lit(self.parts)).cast("int")

    def _signed(self, touched: list[int] | None = None) -> DataFrame:
        rows = self._read("signed", SIGNED + ", part int")
        return rows if touched is None else rows.filter(F.col("part").isin(touched))

    def on_record(self, docs: DataFrame | None = None) -> DataFrame:
        """The group and count of every document, or of ``docs`` (``doc_id``, each once), one row a
        tokenizer."""
        signed = self._signed()
        if docs is not None:
            # at most one row a part
            touched = [r["part"] for r in docs.select(self._part().alias("part")).distinct().collect()]
            signed = self._signed(touched).join(counted(docs.select("doc_id")), "doc_id", "left_semi")
        sums = signed.groupBy("doc_id", "source", "lang", "tokenizer").agg(
            F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")
        )
        return sums.filter("docs != 0")

    def _write(self, signed: DataFrame, attempt: str) -> None:
        """Signed rows by part, large parts in several files, and their rollup."""
        path = f"{self.root}/signed/attempt={attempt}"
        signed.withColumn("part", self._part()).hint("rebalance", "part").write.partitionBy("part").parquet(path)
        rows = self.spark.read.schema(SIGNED + ", part int").parquet(path)
        sums = rows.groupBy("source", "lang", "tokenizer")
        sums = sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        sums.write.parquet(f"{self.root}/rollup/attempt={attempt}")

    def fold(self) -> None:
        """Sums the signed rows of all committed batches; committed numbers stay committed."""
        before, batches = self._newest_fold(), sorted(self._commits())
        number = before["number"] + 1 if before else 0
        attempt = f"fold-{uuid.uuid4().hex}"
        self._write(self.on_record(), attempt)
        row = self.spark.createDataFrame([(number, attempt, batches)], "number bigint, attempt string, batches array<bigint>")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/folds/{number}")

    def commit(self, batch: int, changes: DataFrame) -> bool:
        """Applies ``changes`` (``kind``, ``doc_id``, ``source``, ``lang``, ``text``, ``seq``) as a
        numbered batch. False, and nothing done, if the batch is committed already."""
        if batch in self._commits():
            return False
        attempt = uuid.uuid4().hex
        sizes = count_tokens(changes, self.ranks)
        rank = F.when(F.col("kind") == DELETE, 2).when(F.col("kind") == REVISE, 1).otherwise(0)
        order = F.struct(F.coalesce("seq", F.lit(0).cast("bigint")), rank, "tokens", "words", "source", "lang")
        last = sizes.groupBy("doc_id").agg(
            F.max_by(F.struct("source", "lang", "kind", "tokens", "words"), order).alias("now")
        )
        last = cut_lineage(last)  # read twice below, and counting is dear
        known = self.on_record(last)
        away = known.select("doc_id", "source", "lang", "tokenizer", -F.col("docs"), -F.col("tokens"))
        each = F.array(
            F.struct(F.lit(BPE).alias("tokenizer"), F.col("now.tokens").alias("tokens")),
            F.struct(F.lit(WORDS).alias("tokenizer"), F.col("now.words").alias("tokens")),
        )
        added = (
            last.filter(F.col("now.kind") != DELETE)
            .select("doc_id", "now.source", "now.lang", F.inline(each))
            .select("doc_id", "source", "lang", "tokenizer", F.lit(1).cast("bigint").alias("docs"), "tokens")
        )
        self._write(added.union(away), f"{batch}-{attempt}")
        row = self.spark.createDataFrame([(batch, attempt)], "batch bigint, attempt string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/{batch}")
        return True

    def totals(self) -> DataFrame:
        """``source``, ``lang``, ``tokenizer``, ``docs``, ``tokens``, from the rollups alone."""
        sums = self._read("rollup", ROLLUP).groupBy("source", "lang", "tokenizer")
        return sums.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).filter("docs != 0")


def deliveries(spark: SparkSession, sf_dir: str) -> list[tuple[int, DataFrame]]:
    """All documents; then those labelled poor revised to their letters in lower case; then those
    labelled toxic deleted; then the second batch once more, as after a lost answer."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    labels = table(spark, sf_dir, "labels")

    def marked(test: str) -> DataFrame:
        return docs.join(counted(labels.filter(test).select("doc_id").distinct()), "doc_id", "left_semi")

    def changes(rows: DataFrame, kind: str, seq: int) -> DataFrame:
        return rows.withColumn("kind", F.lit(kind)).withColumn("seq", F.lit(seq))

    revised = changes(marked("quality = 0").withColumn("text", F.lower("text")), REVISE, 1)
    deleted = changes(marked("toxic = 1"), DELETE, 2)
    return [(0, changes(docs, INSERT, 0)), (1, revised), (2, deleted), (1, revised)]


def op8_token_counts(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    ranks = Ranks.from_tokenizers(path or public_tokenizers.path(VOCABULARY))
    rollup = Rollup(spark, scratch_path(spark, "token-counts"), ranks)
    for batch, changes in deliveries(spark, sf_dir):
        rollup.commit(batch, changes)
    return rollup.totals()
