"""Quality rules: a decision list learned by sequential covering, run as Spark conditionals.

Statistics of a text are built-in array and string functions; nothing leaves the JVM. Rules are
learned from a bounded sample of labelled documents: every step of growth is one aggregate that
counts labelled rows by feature and bin, from which the driver sees a few hundred counts only. The
list becomes one ordered ``CASE WHEN`` over the statistics.

Defined results: a null or empty text has no words and fails the base rule. Repeated rows are
judged each for itself, alike. Without usable labels no rule is learned and the base rule decides.
An empty table gives an empty result. Columns beyond ``doc_id`` and ``text`` are ignored by
``statistics`` and kept by ``keep_good``. Repeated windows are recognised by 64-bit hashes.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.llm.common import WHITE_SPACE, id_and_text, labelled_sample, table
from starbrook.session import cut_lineage

SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

# Learning: labelled rows used at most, bins a feature, rules, conditions a rule, and the part of
# the pruning rows a rule rejects that must be labelled bad.
TRAINING_ROWS = 20_000
BINS = 32
MOST_RULES = 8
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.95
LEAST_COVER = 5

FEATURES = ("n_words", "word_length", "symbol_rate", "line_repeats", "word_repeats")


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self, of) -> Column:
        value = of(self.feature)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _with_words(rows: DataFrame, text: str) -> DataFrame:
    """Adds ``_s``: the arrays that the counts are taken from.

    Each step is a projection of its own, and every array is referred to more than once, so that
    the optimizer does not move its evaluation into the lambda functions that read it.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, WHITE_SPACE), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda x: F.length(F.regexp_replace(x, WHITE_SPACE, "")) > 0)
    step = rows.withColumn("_words", F.transform(words, lambda w: F.xxhash64(w))).withColumn("_lines", lines)
    hashes = F.col("_words")
    windows = F.when(
        F.size(hashes) >= WINDOW,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - WINDOW),
            # element by element: slice() would copy the whole array for each window
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))),
        ),
    ).otherwise(F.expr("cast(array() as array<bigint>)"))
    step = step.withColumn("_windows", windows)
    seen = F.col("_windows")
    # sorted, equal windows are neighbours; most texts have none and skip the sort
    placed = F.when(
        F.size(F.array_distinct(seen)) < F.size(seen),
        F.sort_array(F.transform(seen, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.expr("cast(array() as array<struct<h:bigint,i:int>>)"))
    step = step.withColumn("_placed", placed)
    entries = F.col("_placed")

    def twin(entry, i):
        after = F.get(entries, i + 1)["h"]
        before = F.get(entries, i - 1)["h"]
        return F.coalesce(entry["h"] == after, F.lit(False)) | F.coalesce(entry["h"] == before, F.lit(False))

    starts = F.sort_array(F.transform(F.filter(entries, twin), lambda e: e["i"]))
    return step.withColumn("_starts", starts)


def _counts(text: str) -> dict[str, Column]:
    starts = F.col("_starts")
    covered = F.transform(
        starts, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW)))
    )
    body = F.coalesce(F.col(text), F.lit(""))
    return {
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.regexp_replace(body, WHITE_SPACE, "")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace(body, f"[^{SYMBOLS}]", "")).cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x),
    }


def _held() -> Column:
    """Always 0, but not deterministic to the optimizer: what is added to it stays a projection of its
    own, so that no filter on the sum moves below the arrays and evaluates them inside lambdas."""
    return F.when(F.spark_partition_id() < 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id``, the five counts and ``base_failed`` of every document. The result may be filtered,
    joined and aggregated by any of them."""
    counted = _with_words(id_and_text(docs), "text").select(
        "doc_id", *((c + _held()).alias(name) for name, c in _counts("text").items())
    )
    return counted.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words")))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)


def feature(name: str) -> Column:
    """A feature as an expression over the counts."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": F.col("word_chars") / words,
        "symbol_rate": F.col("n_symbols") / words,
        "line_repeats": F.col("n_dup_lines").cast("double"),
        "word_repeats": F.col("n_repeat_words") / words,
    }[name]


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """Features of a bounded sample of the labelled documents that pass the base rule."""
    # at most ``rows`` ids and labels
    sample = F.broadcast(labelled_sample(labels, "quality", rows))
    chosen = id_and_text(docs).join(sample, "doc_id")
    labelled = _with_words(chosen, "text").select(
        "doc_id", "label", *(c.alias(name) for name, c in _counts("text").items())
    )
    # written first: a filter would be moved below the arrays and evaluate them for itself
    labelled = cut_lineage(labelled)
    usable = labelled.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
    return usable.select(
        (F.col("label") == 0).alias("bad"),
        (F.pmod(F.xxhash64(F.lit("prune"), F.col("doc_id")), F.lit(3)) == 0).alias("prune"),
        *(feature(name).alias(name) for name in FEATURES),
    )


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Thresholds of each feature: quantiles of the good and of the bad rows."""
    parts = [i / BINS for i in range(BINS + 1)]
    found = rows.groupBy("bad").agg(
        *(F.percentile_approx(name, F.lit(parts), 1000).alias(name) for name in FEATURES)
    )
    cuts: dict[str, set] = defaultdict(set)
    for row in found.collect():  # two rows
        for name in FEATURES:
            cuts[name].update(row[name] or [])
    return {name: sorted(cuts[name]) for name in FEATURES}


def _bin(name: str, cuts: list[float]) -> Column:
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= F.col(name)))


def _histogram(rows: DataFrame, cuts: dict[str, list[float]]) -> dict:
    """(prune, bad, feature, bin) -> rows; a bin holds the values from one cut up to the next."""
    bins = [
        F.struct(F.lit(k).alias("f"), _bin(name, cuts[name]).alias("b"))
        for k, name in enumerate(FEATURES)
        if cuts[name]
    ]
    if not bins:
        return {}
    counted = (
        rows.select("prune", "bad", F.inline(F.array(*bins))).groupBy("prune", "bad", "f", "b").count()
    )
    return {(r["prune"], r["bad"], FEATURES[r["f"]], r["b"]): r["count"] for r in counted.collect()}


def _satisfying(histogram: dict, cuts: dict, prune: bool):
    """For each possible condition the bad and good rows that satisfy it."""
    for name in FEATURES:
        counts = [
            [histogram.get((prune, bad, name, i), 0) for i in range(len(cuts[name]) + 1)]
            for bad in (True, False)
        ]
        for k, threshold in enumerate(cuts[name]):
            yield Condition(name, True, threshold), [sum(c[k + 1 :]) for c in counts]
            yield Condition(name, False, threshold), [sum(c[: k + 1]) for c in counts]


def _both(conditions: Rule) -> Column:
    column = F.lit(True)
    for c in conditions:
        column = column & c.column(F.col)
    return column


def _grow(rows: DataFrame, cuts: dict) -> Rule:
    """Adds the condition of the largest information gain until no good row is left covered."""
    rule: Rule = ()
    while len(rule) < MOST_CONDITIONS:
        histogram = _histogram(rows.filter(_both(rule)), cuts)
        bad, good = (
            sum(n for (p, b, f, _), n in histogram.items() if not p and b == wanted and f == FEATURES[0])
            for wanted in (True, False)
        )
        if not bad or not good:
            break
        best, gain = None, 0.0
        for condition, (b, g) in _satisfying(histogram, cuts, prune=False):
            if b >= LEAST_COVER:
                now = b * (log2(b / (b + g)) - log2(bad / (bad + good)))
                if now > gain + 1e-9:
                    best, gain = condition, now
        if best is None:
            break
        rule = (*rule, best)
    return rule


def _prune(rows: DataFrame, rule: Rule) -> tuple[Rule, int, int]:
    """The beginning of the rule that does best on rows it was not grown on."""
    held = rows.filter("prune")
    counts = held.agg(
        *(
            F.count_if(_both(rule[:k]) & (F.col("bad") if bad else ~F.col("bad"))).alias(f"n{k}_{int(bad)}")
            for k in range(1, len(rule) + 1)
            for bad in (True, False)
        )
    ).first()
    scored = [(counts[f"n{k}_1"], counts[f"n{k}_0"], k) for k in range(1, len(rule) + 1)]
    bad, good, k = max(scored, key=lambda s: ((s[0] - s[1]) / max(1, s[0] + s[1]), s[0], -s[2]))
    return rule[:k], bad, good


def learn(rows: DataFrame) -> list[Rule]:
    """The ordered rules; each rejects. Learning stops at the first rule that is not precise."""
    cuts = _cuts(rows)
    rules: list[Rule] = []
    while len(rules) < MOST_RULES and any(cuts.values()):
        rule = _grow(rows, cuts)
        if not rule:
            break
        rule, bad, good = _prune(rows, rule)
        if bad < 1 or bad < LEAST_PRECISION * (bad + good):
            break
        rules.append(rule)
        rows = rows.filter(~_both(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True where the list keeps a document: the first rule that holds rejects it."""
    chain = None
    for rule in rules:
        test = F.lit(True)
        for c in rule:
            test = test & c.column(feature)
        chain = F.when(test, F.lit(False)) if chain is None else chain.when(test, F.lit(False))
    return F.lit(True) if chain is None else chain.otherwise(F.lit(True))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics of every document with ``kept``."""
    stats = statistics(docs)
    return stats.withColumn("kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules)))


def keep_good(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns, in one pass and without a join.

    The partition number, not being deterministic to the optimizer, holds the filter above the
    projections; moved below, it would evaluate their arrays again inside lambda functions.
    """
    row = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        F.col("text").cast("string").alias("text"),
    )
    counted = _with_words(row, "text").select(
        "_row",
        *(c.alias(name) for name, c in _counts("text").items()),
        F.spark_partition_id().alias("_part"),
    )
    good = (F.col("_part") >= 0) & ~base_failed(F.col("n_words"), F.col("n_repeat_words")) & verdict(rules)
    return counted.filter(good).select("_row.*")


def learn_from(spark: SparkSession, docs: DataFrame, sf_dir: str) -> list[Rule]:
    return learn(training_rows(docs, table(spark, sf_dir, "labels")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge(docs, learn_from(spark, docs, sf_dir))
