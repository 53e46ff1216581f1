"""Language-model scoring: the marginal probability of a text over all segmentations into subwords.

A text is its words, A-Z lower-cased, and one end. The words' pieces come from an existing vocabulary;
its scores give the pieces' first weights, and expectation steps over the training words bring them to
the corpus: every step counts how often each piece is used over all segmentations of every distinct
word (``lattice``), adds those counts up in Spark, and mixes them with the vocabulary's weights, so
that no piece is impossible. Words are independent, so the probability of a text is the product of the
marginal probabilities of its words and of the end.

1. Words are counted in the tasks and then by Spark: one row a distinct word, with its count in the
   training rows and in all rows.
2. ``STEPS`` expectation steps over the distinct training words; a task returns at most one number a
   piece.
3. Every distinct word gets its marginal log-probability once.
4. Texts look their words up. The most frequent words, at most ``HOT_WORDS``, are broadcast; they hold
   most occurrences. The rest is joined by word, once for each text and task, and added up by text.

Defined results: a null text is empty and has the end only. A score depends on the text alone, so
repeated rows get equal scores; texts are told apart by 128 bits of their hashes. Without training rows
the vocabulary's own weights hold and every count is 0. A null id is neither learned from nor held
out. An empty table gives an empty result. Columns beyond ``doc_id`` and ``text`` are ignored. Bytes
that are no piece's are pieces of their own, so every word has a probability.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log, log10

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.llm.common import id_and_text, table, written
from starbrook.llm.lattice import Pieces, expected_pieces, pieces, word_scores


VOCABULARY = "piece_bpe_32k.model"
STEPS = 3
HELD_OUT = 2  # remainder of the fold that is scored only
FOLDS = 7
HOT_WORDS = 200_000
# entries a task counts before it hands them on
HELD_WORDS = 500_000
KNOWN_TEXTS = 100_000  # hashes a task remembers, not to hand on the words of a copy again
END = b""  # stands for the end among the words; no word is empty


@dataclass(frozen=True)
class Model:
    """``words``: word, n (all rows), c (training rows), logp (natural); what the whole training holds."""

    words: DataFrame
    weight: np.ndarray  # of the pieces, and last of the end
    training_tokens: int
    kinds: int
    training_docs: int

    def base(self, count: Column) -> Column:
        return F.log10((count + 1) / F.lit(float(self.training_tokens + self.kinds + 1)))

    def end_base(self) -> float:
        return log10((self.training_docs + 1) / (self.training_tokens + self.kinds + 1))


def held_out() -> Column:
    rest = F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT
    return F.coalesce(rest, F.lit(False))


def _learned_from() -> Column:
    return F.col("doc_id").isNotNull() & ~held_out()


def _words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased; no other letter is changed."""
    return text.lower().split()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    learned, other = Counter(), Counter()

    def flush():
        for counter, kind in ((learned, True), (other, False)):
            if counter:
                n = pa.array(list(counter.values()), pa.int64())
                zero = pa.array(np.zeros(len(counter), dtype=np.int64))
                columns = [pa.array(list(counter), pa.binary()), n, n if kind else zero]
                yield pa.RecordBatch.from_arrays(columns, ["word", "n", "c"])
                counter.clear()

    for batch in batches:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        for text, learn in zip(texts, batch["learn"].to_pylist(), strict=True):
            (learned if learn else other).update(_words(text))
        if len(learned) + len(other) > HELD_WORDS:
            yield from flush()
    yield from flush()


def count_words(rows: DataFrame) -> DataFrame:
    """``word``, ``n``, ``c`` of every distinct word of ``text``; c counts rows marked ``learn``."""
    partial = rows.select("text", "learn").mapInArrow(_count, "word binary, n bigint, c bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"), F.sum("c").alias("c"))


def _expect(shared: Broadcast, weight: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary: Pieces = shared.value
        total = np.zeros(vocabulary.count)
        for batch in batches:
            times = batch["c"].to_numpy().astype(float)
            total += expected_pieces(batch["word"].to_pylist(), times, vocabulary, np.log(weight))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(total[used])], ["piece", "times"]
        )

    return run


def learn_weights(words: DataFrame, shared: Broadcast, docs: int, steps: int = STEPS) -> np.ndarray:
    """Weights of the pieces and of the end: the vocabulary's, brought to the training words."""
    vocabulary: Pieces = shared.value
    weight = vocabulary.prior
    training = words.filter("c > 0").select("word", "c")
    for _ in range(steps):
        found = training.mapInArrow(_expect(shared, weight), "piece int, times double")
        # at most one row a piece
        sums = found.groupBy("piece").agg(F.sum("times").alias("times")).collect()
        times = np.zeros(vocabulary.count + 1)
        times[-1] = docs
        for row in sums:
            times[row["piece"]] = row["times"]
        # as if the vocabulary's weights had been seen once for each piece
        mixed = times + vocabulary.count * vocabulary.prior
        weight = mixed / mixed.sum()
    return weight


def _spell(shared: Broadcast, weight: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = word_scores(batch["word"].to_pylist(), shared.value, np.log(weight))
            columns = [batch["word"], batch["n"], batch["c"], pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "c", "logp"])

    return run


def learn(docs: DataFrame, vocabulary: str | None = None, steps: int = STEPS) -> Model:
    """The model of ``docs``; ``vocabulary`` is the path of a sentencepiece model."""
    spark = docs.sparkSession
    rows = id_and_text(docs).select("text", _learned_from().alias("learn"))
    words = written(count_words(rows), "lm-words")
    n_docs = rows.filter("learn").count()
    sums = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)).alias("tokens"), F.count_if(F.col("c") > 0).alias("kinds")
    ).first()
    # the size of the vocabulary
    shared = spark.sparkContext.broadcast(pieces(vocabulary or public_tokenizers.path(VOCABULARY)))
    weight = learn_weights(words, shared, n_docs, steps)
    spelt = written(words.mapInArrow(_spell(shared, weight), "word binary, n bigint, c bigint, logp double"), "lm-spelt")
    return Model(spelt, weight, sums["tokens"] + n_docs, sums["kinds"] + (n_docs > 0), n_docs)


def _hot_from(words: DataFrame, most: int) -> float:
    """The least count from which on there are at most ``most`` words, to an eighth of a power of two."""
    # a few hundred rows
    sizes = words.groupBy(F.floor(F.log2("n") * 8).alias("b")).count().orderBy(F.desc("b")).collect()
    above, least = 0, float("inf")
    for row in sizes:
        above += row["count"]
        if above > most:
            break
        least = row["b"]
    return least


SCORED = (
    "doc_id bigint, h1 bigint, h2 bigint, n_tokens bigint, n_known bigint, base double, logp double, "
    "rest bigint, words array<binary>, times array<bigint>"
)


def _look_up(shared: Broadcast):
    """Sums over the broadcast words, and the other words of each text with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known, base, logp = shared.value
        handed: set[tuple[int, int]] = set()
        for batch in batches:
            h1, h2 = batch["h1"].to_pylist(), batch["h2"].to_pylist()
            sums, words, times = [], [], []
            for text, key in zip(batch["text"].cast(pa.binary()).to_pylist(), zip(h1, h2), strict=True):
                counter = Counter(_words(text))
                place = np.fromiter((index.get(w, -1) for w in counter), np.int64, len(counter))
                count = np.fromiter(counter.values(), np.int64, len(counter))
                hot = place >= 0
                at, n = place[hot], count[hot]
                rest = int(count.sum() - n.sum())
                sums.append((int(count.sum()), int((n * known[at]).sum()), n @ base[at], n @ logp[at], rest))
                if rest and key not in handed:
                    if len(handed) < KNOWN_TEXTS:
                        handed.add(key)
                    cold = ~hot
                    words.append([w for w, c in zip(counter, cold, strict=True) if c])
                    times.append(count[cold])
                else:
                    words.append([])
                    times.append([])
            columns = list(zip(*sums, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["h1"],
                    batch["h2"],
                    *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                    pa.array(words, pa.list_(pa.binary())),
                    pa.array(times, pa.list_(pa.int64())),
                ],
                [f.split()[0] for f in SCORED.split(", ")],
            )

    return run


def score(docs: DataFrame, model: Model, hot_words: int = HOT_WORDS) -> DataFrame:
    """The contract's columns for every row."""
    rows = id_and_text(docs).select(
        "doc_id", "text", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("again"), "text").alias("h2")
    )
    valued = model.words.withColumn("base", model.base(F.col("c")))
    bucket = F.floor(F.log2("n") * 8)
    least = _hot_from(model.words, hot_words)
    # at most hot_words rows
    hot = valued.filter(bucket >= F.lit(least)).select("word", (F.col("c") > 0).alias("known"), "base", "logp")
    held = hot.toArrow()
    index = {w: i for i, w in enumerate(held["word"].to_pylist())}
    values = [held["known"].to_numpy().astype(np.int64), held["base"].to_numpy(), held["logp"].to_numpy()]
    shared = docs.sparkSession.sparkContext.broadcast((index, *values))
    scored = written(rows.mapInArrow(_look_up(shared), SCORED), "lm-scored")
    cold = valued.filter(bucket < F.lit(least)).select("word", "c", "base", "logp")
    asked = scored.select("h1", "h2", F.inline(F.arrays_zip("words", "times"))).toDF("h1", "h2", "word", "m")
    # A text handed on by several tasks adds up as often, which the tokens it has tell.
    added = (
        asked.join(cold, "word")
        .groupBy("h1", "h2")
        .agg(
            F.sum("m").alias("a_tokens"),
            F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("a_known"),
            F.sum(F.col("m") * F.col("base")).alias("a_base"),
            F.sum(F.col("m") * F.col("logp")).alias("a_logp"),
        )
    )
    found = scored.drop("words", "times").join(added, ["h1", "h2"], "left")
    times = F.col("a_tokens") / F.col("rest")

    def whole(own: str, more: str) -> Column:
        return F.col(own) + F.coalesce(F.col(more) / times, F.lit(0.0))

    end = log(model.weight[-1])
    return found.select(
        "doc_id",
        held_out().alias("held_out"),
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.round(whole("n_known", "a_known")).cast("bigint") + int(model.training_docs > 0)).alias("n_known"),
        F.lit(model.training_tokens).cast("bigint").alias("train_tokens"),
        (whole("base", "a_base") + model.end_base()).alias("base_score"),
        ((whole("logp", "a_logp") + end) / log(10)).alias("score"),
    )


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn(docs))
