import random
import re
import time
from collections import Counter

from starbrook.llm import quality_rules as Q

SF = "/root/testdata/sf0.001"


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    windows = [tuple(words[i : i + 8]) for i in range(n - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_statistics(documents, rows):
    found = {r.doc_id: tuple(r)[1:] for r in Q.statistics(documents).collect()}
    assert found == {i: brute(t) for i, t in rows}


def test_statistics_of_odd_texts(spark, odd, none):
    rng = random.Random(2)
    texts = [r.text for r in odd.collect()]
    for _ in range(60):  # many repeats, odd spacing
        text = "".join(rng.choice(["a", "b", "ü "]) + rng.choice([" ", "  ", "\n", "\t", "\x0b"]) for _ in range(rng.randint(0, 60)))
        texts.append(text + rng.choice(["", "\n" + text, "\n\n \n"]))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: tuple(r)[1:] for r in Q.statistics(rows).collect()} == {i: brute(t) for i, t in enumerate(texts)}
    assert Q.statistics(none).collect() == [] and Q.keep_good(none, []).collect() == []
    kept = Q.keep_good(odd, [])
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == []


def labelled(spark, n=600):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7)))
    rows = []
    for i in range(n):
        words, kind = [word() for _ in range(rng.randint(30, 60))], rng.random()
        if kind < 0.15:
            words = [w[:-1] + rng.choice("#%") for w in words]
        elif kind < 0.3:
            words = [w * 4 for w in words]
        rows.append((i, " ".join(words), int(kind >= 0.3)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    return docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id bigint, quality int"), rows


def test_learned_list(spark):
    docs, labels, rows = labelled(spark)
    rules = Q.learn(Q.training_rows(docs, labels))
    assert 2 <= len(rules) <= Q.MOST_RULES
    found = {r.doc_id: r.kept for r in Q.judge(docs, rules).collect()}
    assert sum(found[i] != bool(q) for i, _, q in rows) <= 6
    assert {r.doc_id for r in Q.keep_good(docs, rules).collect()} == {i for i, kept in found.items() if kept}


def test_list_is_an_ordered_conditional(spark):
    rules = [(Q.Condition("symbol_rate", True, 0.5), Q.Condition("n_words", False, 30.0)), (Q.Condition("word_length", True, 9.0),)]
    text = str(Q.verdict(rules))
    assert text.index("n_symbols") < text.index("word_chars") and text.count("WHEN") == 2
    assert [str(c) for c in rules[0]] == ["symbol_rate >= 0.5", "n_words < 30"]


def test_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert Q.learn(Q.training_rows(documents, none)) == []
    one = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7)], "doc_id bigint, quality int")
    assert Q.learn(Q.training_rows(documents, one)) == []


def test_query(spark):
    found = Q.op10_quality_rules(spark, SF)
    assert found.columns[:8] == [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    ]
    assert all(not r.kept for r in found.collect() if r.base_failed)


def test_verdicts_can_be_filtered_and_joined(spark):
    """A filter must not be evaluated inside the lambdas below it, which long texts make endless."""
    sizes = [1, 60, 1_000, 30_000]
    texts = [(n, " ".join(f"w{i % 700}" for i in range(n))) for n in sizes]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    judged = Q.judge(docs, [(Q.Condition("symbol_rate", True, 0.3),)])
    begun = time.monotonic()
    assert sorted(r.doc_id for r in judged.filter("kept").collect()) == [60]
    assert [r.doc_id for r in judged.filter("n_repeat_words > 900").collect()] == [30_000]
    other = spark.createDataFrame([(1_000, "x"), (60, "y")], "doc_id bigint, y string")
    joined = judged.join(other, "doc_id").filter("n_words > 100")
    assert [(r.doc_id, r.y) for r in joined.collect()] == [(1_000, "x")]
    total = judged.filter("not kept").agg({"n_words": "sum"}).first()[0]
    assert total == 1 + 1_000 + 30_000
    assert time.monotonic() - begun < 60
