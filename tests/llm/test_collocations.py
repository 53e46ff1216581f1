import random
import re
import struct
from collections import Counter, defaultdict

import pytest

from starbrook.llm import collocations as C
from starbrook.llm import hat_trie as H

SCHEMA = "doc_id bigint, text string, lang string"


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least=30, top=2000):
    """The contract word for word, over all phrases."""
    f, total = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    result = set()
    for lang, counts in f.items():
        found = []
        frequent = [p for p, n in counts.items() if n >= least and len(p) > 1]
        for p in frequent:
            a = counts[p]
            inside = any(
                100 * counts[q] >= 80 * a
                for q in frequent
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
            )
            if not inside:
                cuts = [(counts[p[:k]], counts[p[k:]], k) for k in range(1, len(p))]
                score, _, left, right = min((2_000_000 * a // (left + right), k, left, right) for left, right, k in cuts)
                text = " ".join(p)
                found.append((-score, -a, text.encode(), text, left, right))
        for rank, (score, a, _, text, left, right) in enumerate(sorted(found)[:top], 1):
            result.add((lang, rank, text, -a, left, right, total[lang], -score))
    return result


def corpus(n=600):
    rng = random.Random(12)
    vocabulary = ["The", "the", "É", "é", "x\x1c", "a b", "1", "st", "new", "york", "city", "﻿"] + [f"w{i}" for i in range(60)]
    phrases = ["new york city hall", "st . paul", "of the", "a a a a a"]
    rows = []
    for i in range(n):
        words = [rng.choice(phrases) if rng.random() < 0.2 else rng.choice(vocabulary) for _ in range(rng.randint(0, 40))]
        text = "".join(w + rng.choice([" ", "  ", "\t", "\n", ", ", "; ", "\r", " \x0b", ":"]) if rng.random() < 0.4 else w + " " for w in words)
        rows.append((i, text, rng.choice(["a", "b", "", None])))
    rows += [(7, "repeated row of words", "a")] * 50 + [(None, None, "a"), (None, "", None)]
    return [*rows, (9, "very long " * 30_000, "long")]


@pytest.mark.parametrize(("least", "bits", "held"), [(30, 1 << 16, 400_000), (5, 1 << 8, 2_000), (2, 1 << 20, 300)])
def test_equals_brute_force(spark, monkeypatch, least, bits, held):
    """Also with a bitmap that lets nearly all through, and with tries that spill all the time."""
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in C.collocations(docs, least, bits=bits, held=held).collect()]
    assert len(got) == len(set(got)) and len(got) > 20
    assert set(got) == brute(rows, least)


def test_only_the_first_of_each_language(spark):
    rows = corpus()
    got = {tuple(r) for r in C.collocations(spark.createDataFrame(rows, SCHEMA), 5, top=3).collect()}
    assert got == brute(rows, 5, 3)


@pytest.mark.parametrize(("burst", "words"), [(4, 2), (16, 3), (100, 4)])
def test_trie_counts_and_spills_in_order(monkeypatch, burst, words):
    monkeypatch.setattr(H, "BURST", burst)
    rng = random.Random(burst)
    trie, want, got = H.HatTrie(), Counter(), Counter()
    for _ in range(60):
        drawn = Counter(
            tuple(min(rng.randrange(1, 30), rng.randrange(1, 30)) if rng.random() < 0.6 else 5 for _ in range(words))
            for _ in range(200)
        )
        counts = {struct.pack(f">{words}I", *k): n for k, n in drawn.items()}
        keys = sorted(counts)
        trie.add(keys, [counts[k] for k in keys])
        want.update(counts)
        assert len(trie) == sum(map(len, trie.parts))
        if len(trie) > 800:
            for run in trie.spill(300):
                rows = list(run)
                assert rows == sorted(rows)
                got.update(dict(rows))
            assert len(trie) <= 300
    rows = list(trie.run())
    assert rows == sorted(rows) and len(rows) == len(trie)
    got.update(dict(rows))
    assert got == want


def test_odd_rows_and_columns(spark):
    schema = f"{SCHEMA}, phrase int, f string, n string"
    docs = spark.createDataFrame([(1, None, None, 1, "t", "t"), (1, "a b", "x", 1, "t", "t")], schema)
    assert C.collocations(docs).collect() == []
    got = {tuple(r) for r in C.collocations(docs, 1).collect()}
    assert got == brute([(1, None, None), (1, "a b", "x")], 1)
    assert C.collocations(docs.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark):
    rows = spark.createDataFrame([(9 * 10**15, 19 * 10**15)], "a bigint, p bigint")
    assert rows.select(C.score(rows["a"], rows["p"]).alias("s")).first().s == 2_000_000 * 9 // 19
