"""Phrase collocations: counts of word sequences in a HAT-trie, scored by their weakest cut.

Phrases of one to four words are counted level by level, exactly:

1. Words, by language. Only words that occur ``LEAST`` times can be part of a frequent phrase.
2. Phrases of two frequent words. 3. Phrases of three and four words all of whose pairs are frequent.

What is frequent on one level reaches the tasks of the next as a bitmap of hashes of a fixed size. A
bit set by chance lets a phrase through that is then counted and found to be rare; no frequent phrase
is ever held back, so the size of the bitmap changes the work and not the result.

A task numbers the words it meets and counts the sequences of their ids in a burst trie (``hat_trie``).
Beyond its budget, whole subtrees leave as sorted runs. The runs meet by prefix (language, all but the
last words, and a salt of the rest, so that a prefix with very many followers is spread), and equal
phrases are added up there.

Candidates, parts and containing phrases are frequent by definition, so cuts and containment are
joins among the frequent phrases. Scores are computed in decimals and do not overflow.

Defined results: a null text is empty, a null language ``und``. Repeated rows count each. Texts without
words add nothing; an empty table, and one without frequent phrases, give an empty result. Columns beyond
``text`` and ``lang`` are ignored. A text of any length is counted whole.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starbrook.llm.common import prepare_workers, table, written
from starbrook.llm.hat_trie import HatTrie

LEAST = 30
LONGEST = 4
TOP = 2000
SCALE = 2_000_000
CONTAINED_PERCENT = 80
UNKNOWN = "und"

# Size of a level's bitmap, in bits; a parameter to raise with the corpus.
FILTER_BITS = 1 << 26
# Entries a task's trie may hold before subtrees are spilled, and words it may number.
HELD = 800_000
HELD_WORDS = 1_000_000
SALTS = 4

BREAK = b"\xff"  # between pieces; no UTF-8 text has this byte
# A-Z to a-z, tabs to spaces, and the characters that end a piece to line feeds
_FOLD = bytes(
    0x0A if b in b".,;:!?" or 0x0A <= b <= 0x0D else 0x20 if b == 0x09 else b + 32 if 0x41 <= b <= 0x5A else b
    for b in range(256)
)


def _rows(docs: DataFrame) -> DataFrame:
    prepare_workers(docs.sparkSession)
    return docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def _texts(batch: pa.RecordBatch) -> dict[str, list[bytes]]:
    """The folded texts of a batch by language."""
    by: dict[str, list[bytes]] = defaultdict(list)
    texts = batch["text"].cast(pa.binary()).to_pylist()
    for lang, text in zip(batch["lang"].to_pylist(), texts, strict=True):
        by[lang].append(text.translate(_FOLD))
    return by


# Level 1


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush():
        for lang, counter in counts.items():
            if counter:
                n = pa.array(list(counter.values()), pa.int64())
                columns = [pa.array([lang] * len(counter)), pa.array(list(counter), pa.binary()), n]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "n"])
        counts.clear()

    for batch in batches:
        for lang, texts in _texts(batch).items():
            for text in texts:
                counts[lang].update(text.split())
        if sum(map(len, counts.values())) > HELD:
            yield from flush()
    yield from flush()


# Bitmaps of what is frequent


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text)


def _places(lang: int, words: list[np.ndarray], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a bitmap for each phrase, given by the hashes of its words."""
    value = np.full(len(words[0]), lang, dtype=np.uint64)
    for word in words:
        value = _mix(value ^ word)
    mask = np.uint64(bits - 1)
    return value & mask, (value >> np.uint64(32)) & mask


class Bitmap:
    def __init__(self, blocks: np.ndarray, bits: int):
        self.blocks, self.bits = blocks, bits

    def has(self, lang: int, words: list[np.ndarray]) -> np.ndarray:
        found = np.ones(len(words[0]), dtype=bool)
        for place in _places(lang, words, self.bits):
            block = self.blocks[(place >> np.uint64(6)).astype(np.int64)]
            found &= (block >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def _set_bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            by: dict[str, list[list[bytes]]] = defaultdict(list)
            for lang, phrase in zip(batch["lang"].to_pylist(), batch["phrase"].to_pylist(), strict=True):
                by[lang].append(phrase.split(b" "))
            places = []
            for lang, phrases in by.items():
                columns = zip(*phrases, strict=True)
                words = [np.array([_hash(w) for w in c], dtype=np.uint64) for c in columns]
                places.extend(_places(_hash(lang.encode()), words, bits))
            place = np.unique(np.concatenate(places))
            block = (place >> np.uint64(6)).astype(np.int64)
            heads = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
            mask = np.bitwise_or.reduceat(np.uint64(1) << (place & np.uint64(63)), heads)
            columns = [pa.array(block[heads]), pa.array(mask.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["block", "mask"])

    return run


def bitmap(frequent: DataFrame, bits: int) -> Broadcast:
    """A bitmap of phrases of one length (lang, phrase), made in the tasks and combined by Spark. The
    driver gets it once, in its fixed size."""
    parts = frequent.select("lang", "phrase").mapInArrow(_set_bits(bits), "block bigint, mask bigint")
    combined = parts.groupBy("block").agg(F.bit_or("mask").alias("mask")).toArrow()
    blocks = np.zeros(bits // 64, dtype=np.uint64)
    blocks[combined["block"].to_numpy()] = combined["mask"].to_numpy().view(np.uint64)
    return frequent.sparkSession.sparkContext.broadcast(Bitmap(blocks, bits))


# Levels 2 to 4


class _Numbers(dict):
    """Ids of the words of one language, from 1 on in the order they are met, and which are frequent."""

    def __init__(self, lang: str, frequent: Bitmap):
        super().__init__({BREAK: 0})
        self.lang, self.frequent = _hash(lang.encode()), frequent
        self.names: list[bytes] = [b""]
        self.hashes = np.zeros(1, dtype=np.uint64)
        self.kept = np.zeros(1, dtype=np.uint64)  # the id itself, or 0 for a rare word

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append(word)
        return number

    def ids(self, texts: list[bytes]) -> np.ndarray:
        """The frequent words of the texts by id; 0 stands for a rare word and between pieces."""
        tokens = b"\n".join(texts).replace(b"\n", b" " + BREAK + b" ").split()
        ids = np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))
        if len(self.names) > len(self.hashes):
            new = np.array([_hash(w) for w in self.names[len(self.hashes) :]], dtype=np.uint64)
            numbers = np.arange(len(self.hashes), len(self.names), dtype=np.uint64)
            self.kept = np.append(self.kept, np.where(self.frequent.has(self.lang, [new]), numbers, 0).astype(np.uint64))
            self.hashes = np.append(self.hashes, new)
        return self.kept[ids]


def _tally(columns: list[np.ndarray]) -> tuple[list[bytes], list[int]]:
    """The distinct rows of some id columns as sorted keys, with their numbers."""
    if len(columns) % 2:
        columns = [*columns, np.zeros(len(columns[0]), dtype=np.uint64)]  # no id: the end of the key
    packed = [a << np.uint64(32) | b for a, b in zip(columns[::2], columns[1::2], strict=True)]
    order = np.lexsort(packed[::-1])
    packed = [p[order] for p in packed]
    if not len(order):
        return [], []
    heads = np.concatenate([[True], np.any([p[1:] != p[:-1] for p in packed], axis=0)])
    at = np.flatnonzero(heads)
    keys = np.stack([p[at] for p in packed], axis=1).astype(">u8")
    size = 8 * len(packed)
    return keys.view(f"V{size}").ravel().tolist(), np.diff(np.append(at, len(order))).tolist()


def _sequences(ids: np.ndarray, numbers: _Numbers, level: int, pairs: Bitmap | None):
    """The columns of all phrases of a level: two words, or three and four of frequent pairs."""
    a, b = ids[:-1], ids[1:]
    linked = (a > 0) & (b > 0)
    if level == 2:
        at = np.flatnonzero(linked)
        yield [a[at], b[at]]
        return
    at = np.flatnonzero(linked)
    linked[at] = pairs.has(numbers.lang, [numbers.hashes[x[at].astype(np.int64)] for x in (a, b)])
    for n in range(3, LONGEST + 1):
        whole = np.ones(max(0, len(ids) - n + 1), dtype=bool)
        for k in range(n - 1):
            whole &= linked[k : k + len(whole)]
        at = np.flatnonzero(whole)
        yield [ids[at + k] for k in range(n)]


def _run_rows(lang: str, numbers: _Numbers, run: Iterator[tuple[bytes, int]], level: int) -> pa.RecordBatch:
    """A sorted run, one row for each prefix (all but the last words) and salt: the rests of their phrases
    in one text, as a run repeats its prefixes over and over, and the counts."""
    keys, counts = zip(*run, strict=True)
    ids = np.frombuffer(b"".join(keys), dtype=">u4").reshape(len(keys), -1).astype(np.int64)
    salt = (numbers.hashes[ids[:, level - 1]] % np.uint64(SALTS)).astype(np.int64)
    prefix = ids[:, : level - 1]
    new = np.concatenate([[0], np.cumsum((prefix[1:] != prefix[:-1]).any(axis=1))])
    order = np.argsort(new * SALTS + salt, kind="stable")
    ids, group = ids[order], (new * SALTS + salt)[order]
    heads = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
    names, edges = numbers.names, np.append(heads, len(order)).tolist()
    rest = [names[i] for i in ids[:, level - 1].tolist()]
    if level > 2:
        rest = [r + b" " + names[i] if i else r for r, i in zip(rest, ids[:, level].tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([lang] * len(heads), pa.string()),
            pa.array([b" ".join([names[i] for i in p]) for p in ids[heads, : level - 1].tolist()], pa.binary()),
            pa.array((group[heads] % SALTS).astype(np.int32)),
            pa.array([b"\n".join(rest[a:b]) for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
            pa.ListArray.from_arrays(np.array(edges, dtype=np.int32), np.array(counts, dtype=np.int64)[order]),
        ],
        ["lang", "prefix", "salt", "rests", "counts"],
    )


RUNS = "lang string, prefix binary, salt int, rests binary, counts array<bigint>"


def _count_phrases(level: int, words: Broadcast, pairs: Broadcast | None, held: int):
    """The sorted runs of a level's phrases."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, _Numbers] = {}
        tries: dict[str, HatTrie] = defaultdict(HatTrie)

        def spill(keep: int):
            for lang, trie in tries.items():
                for part in trie.spill(keep // len(tries)):
                    yield _run_rows(lang, known[lang], part, level)

        for batch in batches:
            for lang, texts in _texts(batch).items():
                if lang not in known:
                    known[lang] = _Numbers(lang, words.value)
                ids = known[lang].ids(texts)
                for columns in _sequences(ids, known[lang], level, pairs.value if pairs else None):
                    tries[lang].add(*_tally(columns))
            if sum(map(len, tries.values())) > held:
                yield from spill(held // 2)
            if sum(map(len, known.values())) > HELD_WORDS:
                yield from spill(0)
                known.clear()
                tries.clear()
        yield from spill(0)

    return run


def _phrases(rows: DataFrame, level: int, words: Broadcast, pairs: Broadcast | None, held: int) -> DataFrame:
    runs = rows.mapInArrow(_count_phrases(level, words, pairs, held), RUNS).repartition("lang", "prefix", "salt")
    rests = F.split(F.col("rests").cast("string"), "\n", -1)
    merged = (
        runs.select("lang", "prefix", "salt", F.inline(F.arrays_zip(rests.alias("rest"), F.col("counts").alias("n"))))
        .toDF("lang", "prefix", "salt", "rest", "n")
        .groupBy("lang", "prefix", "salt", "rest")
        .agg(F.sum("n").alias("f"))
    )
    return merged.select("lang", F.concat_ws(" ", F.col("prefix").cast("string"), "rest").alias("phrase"), "f")


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, bits: int = FILTER_BITS, held: int = HELD
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase``, ``f`` of the phrases of one to four words that occur ``least`` times, and
    ``lang``, ``n``: all words of each language."""
    rows = _rows(docs)
    partial = rows.mapInArrow(_count_words, "lang string, phrase binary, n bigint")
    counts = partial.groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    # rare words are needed for the totals only: one row a language and count remains of them
    rare = F.col("f") < least
    counts = written(
        counts.groupBy("lang", "f", F.when(~rare, F.col("phrase")).alias("phrase")).agg(F.count(F.lit(1)).alias("m")),
        "phrases-1",
    )
    totals = counts.groupBy("lang").agg(F.sum(F.col("f") * F.col("m")).alias("n"))
    frequent = [counts.filter(F.col("phrase").isNotNull()).select("lang", "phrase", "f")]
    marks = bitmap(frequent[0], bits)
    pairs = None
    for level in (2, 3):
        found = _phrases(rows, level, marks, pairs, held).filter(F.col("f") >= least)
        frequent.append(written(found, f"phrases-{level}"))
        if level == 2:
            pairs = bitmap(frequent[1].withColumn("phrase", F.col("phrase").cast("binary")), bits)
    words = frequent[0].withColumn("phrase", F.col("phrase").cast("string"))
    return words.unionByName(frequent[1]).unionByName(frequent[2]), totals


# Scores


def _part(start, length) -> Column:
    return F.array_join(F.slice("words", start, length), " ")


def score(a: Column, parts: Column) -> Column:
    """floor(2,000,000 a / parts), exact."""
    exact = a.cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", exact, parts.cast("decimal(20,0)"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, bits: int = FILTER_BITS, held: int = HELD) -> DataFrame:
    """The ``top`` phrases of each language with the counts of their weakest cut."""
    phrases, totals = frequent_phrases(docs, least, bits, held)
    split = phrases.withColumn("words", F.split("phrase", " ", -1)).withColumn("k", F.size("words"))
    # phrases of more words are few; their parts are found by joins on (lang, phrase)
    candidates = split.filter("k > 1")
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), "words", "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")
    ).select("lang", "phrase", "a", "cut", _part(1, F.col("cut")).alias("left"), _part(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("right"))
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    weakest = (
        scored.withColumn("score", score(F.col("a"), F.col("l") + F.col("r")))
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    )
    inner = (
        candidates.filter("k > 2")
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
        .select("lang", _part(F.col("start"), F.col("size")).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    whole = weakest.join(inner, ["lang", "phrase"], "left").filter(
        F.coalesce(100 * F.col("longer") < CONTAINED_PERCENT * F.col("a"), F.lit(True))
    )
    order = W.partitionBy("lang").orderBy(F.desc("w.score"), F.desc("a"), "phrase")
    ranked = whole.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang",
        F.col("rank").cast("bigint").alias("rank"),
        "phrase",
        "a",
        *(F.col(f"w.{c}").alias(c) for c in ("l", "r")),
        "n",
        F.col("w.score").alias("score"),
    )


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = """
    WITH docs AS (
        SELECT coalesce(lang, 'und') AS lang,
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
        FROM documents
    ),
    pieces AS (
        SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
        FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM docs)
    ),
    grams AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3), (4)) t(k))
    ),
    counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
    freq AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30),
    cuts AS (SELECT lang, k, phrase, f AS a, w, unnest(range(1, k)) AS cut FROM freq WHERE k > 1),
    scored AS (
        SELECT c.lang, c.phrase, a, cut, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f + r.f))::BIGINT AS score
        FROM cuts c
            JOIN freq l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:cut], ' ')
            JOIN freq r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:c.k], ' ')
    ),
    weakest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ),
    inside AS (
        SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS longer
        FROM (SELECT lang, w, f, s, unnest(range(1, k - s + 2)) AS i
              FROM (SELECT *, unnest(range(2, k)) AS s FROM freq WHERE k > 2))
        GROUP BY ALL
    )
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
        phrase, a, l, r, n, score
    FROM weakest LEFT JOIN inside USING (lang, phrase) JOIN totals USING (lang)
    WHERE longer IS NULL OR 100 * longer < 80 * a
    QUALIFY rank <= 2000
"""
