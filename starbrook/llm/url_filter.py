"""URL filter: host and path rules, and a logistic regression on hashed character n-grams.

A rule fits its host and all subdomains where the path starts with the rule's; the longest rule that
fits decides, by one ordered conditional. Other urls are judged by the regression. Its features are
the distinct character n-grams of host and path, hashed into a fixed number of weights.

All is Spark: parsing, features, scores, and training, where every step of the (accelerated)
gradient descent is one aggregate over the labelled table that returns a sum for each weight. The
labelled table is small: at most ``TRAINING_URLS`` distinct urls, here those that rules decide.

Rules often go by the host's last label, which says little about hosts that end otherwise. So every
labelled url is learned from twice, once without that label, and both kinds weigh alike. One host in
``FOLDS`` is held out, whole; where block begins is the cut that judges those hosts best without their
last label, and the model carries its accuracy on them.

Defined results: host and path of a null url, or of one without ``://``, are empty. Rows are judged
each for itself. With labels of one kind only that kind is the verdict, without labels it is allow.
Of two rules of equal length that fit, that of the longer host decides. An empty table gives an
empty result. Columns beyond ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass, field, replace
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.llm.common import table
from starbrook.session import cut_lineage

ALLOW, BLOCK = "allow", "block"
# fixed values: verdict and rule
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

GRAMS = (3, 4, 5)
WEIGHTS = 4096
TRAINING_URLS = 4_000
STEPS = 25
RIDGE = 1e-4
FOLDS = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url))).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase), path


def parse(pages: DataFrame) -> DataFrame:
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url")
    )
    host, path = host_and_path(F.col("url"))
    return rows.select("page_id", host.alias("host"), path.alias("path"))


def _fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    named = (F.col("host") == host) | F.endswith(F.col("host"), F.lit("." + host))
    return named & F.startswith(F.col("path"), F.lit(slash + path))


def decide(rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The rule that decides and its verdict, both null where none fits."""
    longest_first = sorted(rules, key=lambda r: (-len(r[1]), -len(r[1].partition("/")[0]), r))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in reversed(longest_first):
        fits = _fits(text)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def with_features(rows: DataFrame) -> DataFrame:
    """Adds ``features``: the weights that the n-grams of host and path use, each once.

    Letters are arrays before they are read by position, since taking substrings of a long text one
    by one would go through it each time; every array is referred to more than once and so is not
    moved into the functions that read it.
    """
    letters = rows.withColumn("_h", F.regexp_extract_all(F.concat(F.lit("^"), "host", F.lit("$")), F.lit("(?s)."), 0))
    letters = letters.withColumn("_p", F.regexp_extract_all(F.concat("path", F.lit("$")), F.lit("(?s)."), 0))
    found = [_grams(name, n) for name in ("_h", "_p") for n in GRAMS]
    return letters.withColumn("features", F.array_distinct(F.concat(*found))).drop("_h", "_p")


def _grams(name: str, n: int) -> Column:
    letters = F.col(name)

    def feature(i):
        gram = F.xxhash64(F.lit(name), F.lit(n), *(F.get(letters, i + k) for k in range(n)))
        return F.pmod(gram, F.lit(WEIGHTS)).cast("int")

    places = F.sequence(F.lit(0), F.size(letters) - n)
    return F.when(F.size(letters) >= n, F.transform(places, feature)).otherwise(F.expr("cast(array() as array<int>)"))


@dataclass
class Model:
    weights: list[float] = field(default_factory=lambda: [0.0] * WEIGHTS)
    bias: float = 0.0
    held_out: int = 0  # urls judged for the accuracy
    accuracy: float | None = None  # the mean of both kinds' shares judged right
    blind_accuracy: float | None = None  # without the hosts' last label

    def logit(self) -> Column:
        """Of a row with ``features``; positive where block is likelier."""
        # one literal that the optimizer folds into an array
        written = F.lit(",".join(f"{w:.8g}" for w in self.weights))
        weights = F.split(written, ",").cast("array<double>")
        total = F.aggregate("features", F.lit(0.0), lambda a, f: a + F.get(weights, f))
        return F.lit(self.bias) + total / F.sqrt(F.greatest(F.size("features"), F.lit(1)))


def _without_ending(host: Column) -> Column:
    return F.regexp_replace(host, r"\.?[^.]*$", "")


def train(labelled: DataFrame) -> Model:
    """From ``host``, ``path`` and ``label`` (1: block) of a table of bounded size."""
    held = (F.pmod(F.xxhash64("host"), F.lit(FOLDS)) == 0).alias("held")
    seen = labelled.select("host", "path", "label", held, F.lit(False).alias("blind"))
    both = seen.unionByName(seen.withColumn("host", _without_ending(F.col("host"))).withColumn("blind", F.lit(True)))
    rows = cut_lineage(with_features(both).select("label", "held", "blind", "features").coalesce(4))
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(kinds) < 2:
        return Model(bias=-50.0 if not kinds.get(1) else 50.0)
    fold = rows.filter("not held")
    if fold.select("label").distinct().count() < 2:  # too few hosts to hold one out
        return _fit(rows)
    model = _fit(fold)
    judged = rows.filter("held").select("label", "blind", model.logit().alias("logit")).collect()  # TRAINING_URLS at most
    return _with_cut(model, [(r["logit"], r["label"], r["blind"]) for r in judged])


def _with_cut(model: Model, judged: list[tuple[float, int, bool]]) -> Model:
    """The model with its bias moved to the best cut; of equal cuts the nearest to the fitted one."""
    blind = sorted((z, y) for z, y, hidden in judged if hidden)
    if len({y for _, y in blind}) < 2:
        return model
    values = sorted({z for z, _ in blind})
    cuts = [0.0, *((a + b) / 2 for a, b in pairwise(values))]
    cut = max(cuts, key=lambda c: (_balanced(blind, c), -abs(c)))
    whole = [(z, y) for z, y, hidden in judged if not hidden]
    return replace(
        model,
        bias=model.bias - cut,
        held_out=len(whole),
        accuracy=_balanced(whole, cut),
        blind_accuracy=_balanced(blind, cut),
    )


def _balanced(judged: list[tuple[float, int]], cut: float) -> float:
    right = [sum((z > cut) == bool(k) for z, y in judged if y == k) for k in (0, 1)]
    return sum(r / sum(y == k for _, y in judged) for k, r in enumerate(right)) / 2


def _fit(rows: DataFrame) -> Model:
    kinds = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n = sum(kinds.values())
    # both kinds weigh alike, so that their numbers do not decide about urls unlike all others
    weight = F.when(F.col("label") == 1, F.lit(n / (2 * kinds[1]))).otherwise(F.lit(n / (2 * kinds[0])))
    rows = rows.withColumn("weight", weight)
    model = Model()
    ahead, pace = model, 1.0
    for _ in range(STEPS):
        slopes = _gradient(rows, ahead)
        # the curvature of the mean loss is at most a quarter of |x|^2 + 1 = 2
        step = 2.0
        new = Model(
            [w - step * (slopes.get(i, 0.0) / n + RIDGE * w) for i, w in enumerate(ahead.weights)],
            ahead.bias - step * slopes.get(-1, 0.0) / n,
        )
        faster = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        momentum = (pace - 1) / faster
        ahead = Model(
            [b + momentum * (b - a) for a, b in zip(model.weights, new.weights, strict=True)],
            new.bias + momentum * (new.bias - model.bias),
        )
        model, pace = new, faster
    return model


def _gradient(rows: DataFrame, model: Model) -> dict[int, float]:
    """The sum of errors by weight; -1 is the bias. At most one row a weight."""
    error = F.col("weight") * (1 / (1 + F.exp(-model.logit())) - F.col("label"))
    missed = rows.withColumn("error", error)
    scaled = missed.select(
        "error",
        (F.col("error") / F.sqrt(F.greatest(F.size("features"), F.lit(1)))).alias("share"),
        F.explode(F.concat(F.array(F.lit(-1)), "features")).alias("feature"),
    )
    value = F.when(F.col("feature") == -1, F.col("error")).otherwise(F.col("share"))
    return {r["feature"]: r["slope"] for r in scaled.groupBy("feature").agg(F.sum(value).alias("slope")).collect()}


def labelled_by_rules(rows: DataFrame, rules: tuple[tuple[str, str], ...]) -> DataFrame:
    """At most ``TRAINING_URLS`` distinct urls that rules decide, in the order of a hash."""
    _, verdict = decide(rules)
    known = rows.select("host", "path", (verdict == BLOCK).cast("int").alias("label")).filter("label is not null")
    return known.distinct().orderBy(F.xxhash64("host", "path"), "host", "path").limit(TRAINING_URLS)


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...], model: Model) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (of block, by the
    regression) of every page."""
    rule, verdict = decide(rules)
    scored = with_features(parse(pages)).withColumn("logit", model.logit())
    learned = F.when(F.col("logit") > 0, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, learned).alias("verdict"),
        (1 / (1 + F.exp(-F.col("logit")))).alias("score"),
    )


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = train(labelled_by_rules(parse(pages), RULES))
    return judge(pages, RULES, model)
