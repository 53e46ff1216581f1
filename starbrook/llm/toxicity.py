"""Toxicity: a learned lexicon, matched with misspellings, and scored by context.

Terms are whole words and word beginnings that occur in toxic labelled texts and hardly elsewhere.
They form a trie. A word is run through the product of that trie with the Levenshtein automata of
its terms: a state is the set of trie nodes reachable with 0, 1, ... edits, and transitions are
built when first met and then kept, so most words leave the automaton after a few letters. Every
hit is put down as abuse or as quotation by a window around it: quotation marks on both sides, or
a word that reports speech shortly before. A hit weighs the log-odds of its term at its number of
edits, as counted in labelled texts; edits never met there weigh a part of the exact term. The sums
of a text feed a logistic regression.

Labels are learned from rows outside the held-out fold, at most ``TRAINING_ROWS`` of them; prefix
counts are aggregated by Spark and the driver receives bounded tables. Scoring is one pass without
a shuffle. A score depends on the text alone.

Defined results: a null or empty text has no hits and gets the score of a text without hits. Rows
are scored each for itself, so repeated rows get equal scores. Without training labels of both
kinds nothing is known and every score is 0. An empty table gives an empty result. Columns beyond
``doc_id`` and ``text`` are ignored by ``score`` and kept by ``keep_clean``. A null id is never
held out.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbrook.llm.common import id_and_text, labelled_sample, steps, table, training_fold
from starbrook.session import cut_lineage

# Learning: labelled rows used at most; the least number of toxic texts that hold a term; the least
# part of a term's texts that are toxic; the least log-likelihood by which that part must beat the
# part of all texts, so that chance makes no terms. Near-copies of one label are one text here.
TRAINING_ROWS = 20_000
LEAST_TEXTS = 5
LEAST_PRECISION = 0.5
LEAST_EVIDENCE = 15.0
PRECISE = 0.9
SHINGLE = 4  # words; texts that share a band of minima of their shingles' hashes are near-copies
BANDS, BAND_ROWS = 12, 2
UNSEEN_EDIT = 0.5  # weight of an edit never met in training, as a part of the weight without it
SHORTEST, LONGEST = 3, 12
END = "\n"  # closes a term that is a whole word; no word contains it

# Context: words before a hit in which a reporting word or an opened quotation counts.
WINDOW = 6
MARKS = frozenset("\"'«»„“”‚‘’‹›")
# fixed values: words that report speech, in the languages of the corpus
REPORTING = frozenset(
    "said says wrote called calls quoted quote quotes reported sagte schrieb nannte zitat dit écrit "
    "appelé citation dijo escribió llamó cita".split()
)
QUOTED_WEIGHT = 0.25


def edits_allowed(term: str) -> int:
    length = len(term.rstrip(END))
    return 0 if length < 5 else 1 if length < 9 else 2


class Automaton:
    """The lexicon trie times the Levenshtein automata of its terms, determinised step by step."""

    MOST_STATES = 20_000

    def __init__(self, terms: list[str]):
        self.letters: list[dict[str, int]] = [{}]
        self.ends: list[int | None] = [None]  # the term that ends here
        self.allowed = [0]  # the most edits any term below a node allows
        for index, term in enumerate(terms):
            node, most = 0, edits_allowed(term)
            self.allowed[0] = max(self.allowed[0], most)
            for letter in term:
                if letter not in self.letters[node]:
                    self.letters[node][letter] = len(self.letters)
                    self.letters.append({})
                    self.ends.append(None)
                    self.allowed.append(0)
                node = self.letters[node][letter]
                self.allowed[node] = max(self.allowed[node], most)
            self.ends[node] = index
        self.most = [edits_allowed(t) for t in terms]
        self._clear()

    def _clear(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.next: list[dict[str, int]] = []
        self.sets: list[dict[int, int]] = []
        self.accepts: list[tuple[tuple[int, int], ...]] = []
        self.start = self._state(self._closed({0: 0}))

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """Adds the nodes reached by leaving out letters of a term."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            cost = nodes[node] + 1
            for letter, child in self.letters[node].items():
                if letter != END and cost <= self.allowed[child] and cost < nodes.get(child, 99):
                    nodes[child] = cost
                    todo.append(child)
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = frozenset(nodes.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.next.append({})
            self.sets.append(nodes)
            ends = ((self.ends[node], cost) for node, cost in nodes.items())
            self.accepts.append(tuple((t, c) for t, c in ends if t is not None and c <= self.most[t]))
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        """The next state, or -1 when no term can be reached any more."""
        after: dict[int, int] = {}

        def reach(node: int, cost: int) -> None:
            if cost <= self.allowed[node] and cost < after.get(node, 99):
                after[node] = cost

        for node, cost in self.sets[state].items():
            for branch, child in self.letters[node].items():
                if branch == letter:
                    reach(child, cost)
                elif END not in (branch, letter):
                    reach(child, cost + 1)
            if letter != END:
                reach(node, cost + 1)
        target = self._state(self._closed(after)) if after else -1
        self.next[state][letter] = target
        return target

    def match(self, word: str) -> frozenset[tuple[int, int]]:
        """(term, edits) of the terms within reach of the word. A term that is a word beginning
        may be followed by anything."""
        if len(self.sets) > self.MOST_STATES:
            self._clear()
        state, found = self.start, ()
        for letter in word + END:
            after = self.next[state].get(letter, -2)
            state = self._step(state, letter) if after == -2 else after
            if state < 0:
                break
            if self.accepts[state]:
                found = (*found, *self.accepts[state])
        return frozenset(found)


def _bare(raw: str) -> str:
    """The word without punctuation around it."""
    if raw.isalnum():
        return raw
    start, end = 0, len(raw)
    while start < end and not raw[start].isalnum():
        start += 1
    while end > start and not raw[end - 1].isalnum():
        end -= 1
    return raw[start:end]


def words_of(text: str) -> list[str]:
    return text.lower().split()


@dataclass
class Model:
    terms: list[str] = field(default_factory=list)
    odds: list[list[float]] = field(default_factory=list)  # by term and edits
    weights: list[float] = field(default_factory=list)
    bias: float = 0.0

    def probability(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(features))
        z = features @ np.array(self.weights) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


class Matcher:
    """What the words of a text hit in a lexicon; remembers the words it has met."""

    MOST_WORDS = 100_000

    def __init__(self, terms: list[str], odds: list[list[float]] | None = None):
        self.automaton = Automaton(terms)
        self.odds = odds
        self.known: dict[str, frozenset | float] = {}

    def _look_up(self, raw: str):
        if len(self.known) > self.MOST_WORDS:
            self.known.clear()
        word = _bare(raw)
        hits = self.automaton.match(word) if word else frozenset()
        if self.odds is not None:
            hits = max((self.odds[t][edits] for t, edits in hits), default=0.0)
        self.known[raw] = hits
        return hits

    def hits(self, raw: list[str]) -> list[tuple[int, frozenset | float]]:
        known, found = self.known, []
        for i, word in enumerate(raw):
            hit = known[word] if word in known else self._look_up(word)
            if hit:
                found.append((i, hit))
        return found

    def features(self, text: str) -> list[float]:
        """Of one text: its weight of abuse in all and to the length, and what is quoted."""
        raw = words_of(text)
        abuse = quoted = 0.0
        for i, weight in self.hits(raw):
            if _is_quoted(raw, i):
                quoted += weight
            else:
                abuse += weight
        total = abuse + QUOTED_WEIGHT * quoted
        return [math.log1p(total), math.sqrt(total / max(1, len(raw))), math.log1p(quoted)]


def _is_quoted(raw: list[str], i: int) -> bool:
    """Whether the window around a hit marks it as somebody else's words."""
    before, after = raw[max(0, i - WINDOW) : i], raw[i + 1 : i + 1 + WINDOW]
    opened = any(w[0] in MARKS for w in (*before, raw[i]))
    closed = any(w.rstrip(".,;:!?")[-1:] in MARKS for w in (raw[i], *after))
    if opened and closed:
        return True
    return any(_bare(w) in REPORTING for w in before)


_matchers: dict[tuple, Matcher] = {}


def matcher(terms: list[str], odds: list[list[float]] | None = None) -> Matcher:
    """One is kept per worker process."""
    key = (tuple(terms), odds is not None and tuple(map(tuple, odds)))
    if key not in _matchers:
        _matchers.clear()
        _matchers[key] = Matcher(terms, odds)
    return _matchers[key]


def _prefixes(text: str) -> set[str]:
    found = set()
    for raw in set(words_of(text)):
        word = _bare(raw)
        if len(word) >= SHORTEST:
            found.update(word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1))
            found.add(word + END)
    return found


def bands(text: str) -> list[int]:
    """A number for each band of a text; near-copies share one with high probability."""
    words = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in words_of(text)], dtype=np.uint64)
    if not len(words):
        return []
    k = min(SHINGLE, len(words))
    # fixed odd numbers; products wrap
    mixed = np.zeros(len(words) - k + 1, dtype=np.uint64)
    for j in range(k):
        mixed = (mixed ^ words[j : len(words) - k + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    mixed, found = np.unique(mixed), []
    for band in range(BANDS):
        value = k * BANDS + band
        for row in range(BAND_ROWS):
            hashed = (mixed ^ np.uint64(0xD1B54A32D192ED03 * (band * BAND_ROWS + row + 1) % 2**64)) * np.uint64(
                0xBF58476D1CE4E5B9
            )
            hashed ^= hashed >> np.uint64(32)
            value = value * 0x100000001B3 + int((hashed * np.uint64(0x94D049BB133111EB)).min())
        found.append(value % 2**63)
    return found


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [bands(t) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["hash"], batch["label"].cast(pa.int32()), pa.array(found, pa.list_(pa.int64()))],
            ["hash", "label", "bands"],
        )


def families(rows: DataFrame) -> tuple[dict[int, int], int, int]:
    """Of labelled rows (``hash``, ``text``, ``label``): the family of each that has near-copies of its
    label, named by one of its hashes; and the numbers of families and of toxic ones."""
    # the driver holds a few numbers for each row of the sample
    seen = rows.select("hash", "label", "text").mapInArrow(_bands, "hash bigint, label int, bands array<bigint>")
    held = sorted(seen.collect(), key=lambda r: (r["hash"], r["label"]))
    above = list(range(len(held)))

    def top(i: int) -> int:
        while above[i] != i:
            above[i] = i = above[above[i]]
        return i

    first: dict[tuple[int, int], int] = {}
    for i, r in enumerate(held):
        for band in r["bands"]:
            a, b = top(first.setdefault((r["label"], band), i)), top(i)
            above[max(a, b)] = min(a, b)
    members = Counter(top(i) for i in range(len(held)))
    named = {r["hash"]: held[top(i)]["hash"] for i, r in enumerate(held) if members[top(i)] > 1}
    return named, len(members), sum(held[i]["label"] for i in members)


def _count_prefixes(named: Broadcast):
    """Counts of the texts that stand alone, and each term once for a family (of 1 label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, own = Counter(), named.value
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("hash", "label", "text"))
            for key, label, text in zip(*columns, strict=True):
                family = own.get(key)
                if family is None:
                    counts.update((term, None, label) for term in _prefixes(text))
                else:
                    counts.update(dict.fromkeys(((term, family, label) for term in _prefixes(text)), 1))
                if len(counts) > 200_000:
                    yield _counted(counts)
        yield _counted(counts)

    return run


def _counted(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    batch = pa.RecordBatch.from_pydict(
        {
            "term": pa.array([t for t, _, _ in keys], pa.string()),
            "family": pa.array([f for _, f, _ in keys], pa.int64()),
            "label": pa.array([x for _, _, x in keys], pa.int32()),
            "n": pa.array([counts[k] if k[1] is None else 1 for k in keys], pa.int64()),
        }
    )
    counts.clear()
    return batch


def lexicon(rows: DataFrame) -> list[str]:
    """Terms from labelled rows (``text``, ``label``): of the beginnings that the same texts hold,
    the longest; none that a precise shorter term already covers. All that pass the tests are kept."""
    rows = rows.select(F.xxhash64("text").alias("hash"), "label", "text")
    named, texts, toxic = families(rows)
    shared = rows.sparkSession.sparkContext.broadcast(named)  # two numbers a row of the sample
    each = rows.mapInArrow(_count_prefixes(shared), "term string, family bigint, label int, n bigint")
    n = F.when(F.col("family").isNull(), F.sum("n")).otherwise(F.max("n"))
    once = each.groupBy("term", "family", "label").agg(n.alias("n"))
    counted = once.groupBy("term").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )
    base = toxic / texts if texts else 0.0
    precision = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    telling = counted.withColumn("precision", precision).filter(
        (F.col("toxic") >= LEAST_TEXTS)
        & (F.col("precision") >= LEAST_PRECISION)
        & (F.col("toxic") * F.log(F.col("precision") / F.lit(max(base, 1e-9))) >= LEAST_EVIDENCE)
    )
    # every term stands in LEAST_TEXTS texts of the sample, which bounds them
    held = {r["term"]: r for r in telling.collect()}
    same = {t[:-1] for t, r in held.items() if t[:-1] in held and r["toxic"] >= 0.98 * held[t[:-1]]["toxic"]}
    chosen: set[str] = set()
    for term in sorted(held.keys() - same, key=lambda t: (len(t), t)):
        precise = any(term[:k] in chosen and held[term[:k]]["precision"] >= PRECISE for k in range(1, len(term)))
        if not precise:
            chosen.add(term)
    return sorted(chosen)


def _count_hits(terms: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = matcher(terms), Counter()
        for batch in batches:
            for label, text in zip(batch["label"].to_pylist(), batch["text"].to_pylist(), strict=True):
                hit = set().union(*(h for _, h in own.hits(words_of(text))))
                counts.update((term, edits, label) for term, edits in hit)
        rows = [(*key, n) for key, n in counts.items()]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
        names = ("term", "edits", "label", "texts")
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], list(names))

    return run


def _odds(rows: DataFrame, terms: list[str]) -> list[list[float]]:
    """Log-odds of every term at every number of edits, none below 0."""
    texts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    counted = (
        rows.select("text", "label")
        .mapInArrow(_count_hits(terms), "term bigint, edits bigint, label bigint, texts bigint")
        .groupBy("term", "edits")
        .pivot("label", [0, 1])
        .agg(F.sum("texts"))
    )
    # at most three rows a term
    found = {(r["term"], r["edits"]): (r["1"] or 0, r["0"] or 0) for r in counted.collect()}
    odds = []
    for t, term in enumerate(terms):
        row: list[float] = []
        for edits in range(edits_allowed(term) + 1):
            toxic, clean = found.get((t, edits), (0, 0))
            if edits and toxic + clean < LEAST_TEXTS:
                row.append(UNSEEN_EDIT * row[-1])
            else:
                p, q = (toxic + 0.5) / (texts.get(1, 0) + 1), (clean + 0.5) / (texts.get(0, 0) + 1)
                row.append(max(0.0, math.log(p / q)))
        odds.append(row)
    return odds


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[list[float], float]:
    """Logistic regression by Newton steps, with a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], 1e-2 * max(1, len(x)) ** 0.5)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return list(map(float, w[:-1])), float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    sample = labelled_sample(labels.filter(training_fold()), "toxic", rows)
    # at most ``rows`` ids and labels are broadcast
    found = id_and_text(docs).join(F.broadcast(sample), "doc_id").withColumn("hash", F.xxhash64("text"))
    # equal texts are one example
    once = found.groupBy("hash").agg(F.max_by(F.struct("text", "label"), "doc_id").alias("row"))
    chosen = cut_lineage(once.select("row.*"))
    terms = lexicon(chosen)
    if not terms:
        return Model()
    odds = _odds(chosen, terms)
    seen = chosen.mapInArrow(_features(terms, odds), "label int, x array<double>").collect()
    y = np.array([r["label"] for r in seen], dtype=float)
    return Model(terms, odds, *_fit(np.array([r["x"] for r in seen]), y))


def _features(terms: list[str], odds: list[list[float]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = matcher(terms, odds)
        for batch in batches:
            x = [own.features(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["label"].cast(pa.int32()), pa.array(x, pa.list_(pa.float64()))], ["label", "x"]
            )

    return run


def _scores(model: Model, texts: list[str]) -> np.ndarray:
    if not texts or not model.weights:
        return np.zeros(len(texts))
    own = matcher(model.terms, model.odds)
    return model.probability(np.array([own.features(t) for t in texts]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in steps(batch["doc_id"], batch["text"]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(_scores(model, texts))], ["doc_id", "score"]
                )

    scored = id_and_text(docs).mapInArrow(run, "doc_id bigint, score double")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch["text"].cast(pa.string()), "")
            clean = [_scores(model, part) < 0.5 for _, part in steps(pa.nulls(len(texts)), texts)]
            yield batch.filter(pa.array(np.concatenate([np.zeros(0, dtype=bool), *clean])))

    return docs.mapInArrow(run, docs.schema)


def learn_from(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    return learn(docs, table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, learn_from(spark, docs, sf_dir))
