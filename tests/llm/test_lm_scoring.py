import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starbrook.llm import lattice as L
from starbrook.llm import lm_scoring as M

SF = "/root/testdata/sf0.001"
SMALL = L.trie({t.encode(): float(i) for i, t in enumerate([" a", "ab", " ", "a", "b", "bab", "é", " ba"])} | {bytes([b]): 500.0 for b in range(256)})


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text or ""))


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def segmentations(word, vocabulary):
    """Every way to cut a marked word into pieces, one by one."""
    strings = {}

    def walk(node, text):
        if vocabulary.piece[node] >= 0:
            strings[text] = vocabulary.piece[node]
        for byte in np.flatnonzero(vocabulary.after[node]):
            walk(vocabulary.after[node, byte], text + bytes([byte]))

    walk(0, b"")

    def cut(rest):
        if not rest:
            yield []
        for k in range(1, len(rest) + 1):
            if rest[:k] in strings:
                for more in cut(rest[k:]):
                    yield [strings[rest[:k]], *more]

    return list(cut(b" " + word))


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text("abé#", min_size=1, max_size=6), min_size=1, max_size=5))
def test_marginals_and_expectations_over_all_segmentations(texts):
    words = [t.encode() for t in texts]
    times = np.arange(1, len(words) + 1)
    log_weight = np.log(SMALL.prior)
    want, use = [], np.zeros(SMALL.count)
    for word, n in zip(words, times, strict=True):
        paths = segmentations(word, SMALL)
        chance = [math.prod(SMALL.prior[p] for p in path) for path in paths]
        want.append(math.log(sum(chance)))
        for path, c in zip(paths, chance, strict=True):
            np.add.at(use, path, n * c / sum(chance))
    assert np.allclose(L.word_scores(words, SMALL, log_weight), want)
    assert np.allclose(L.expected_pieces(words, times, SMALL, log_weight), use)


def test_vocabulary_holds_folded_pieces():
    found = L.pieces(public_tokenizers.path(M.VOCABULARY))
    assert found.count > 20_000 and abs(found.prior.sum() - 1) < 1e-9
    # no piece has a mark inside, so matches never cross words
    assert not found.after[found.after[found.after > 0].astype(int), 0x20].any()


def brute(rows):
    """Base scores word by word, and the model's from a plain sum over all arcs of each word."""
    train = Counter()
    for i, text in rows:
        if i is not None and not held(i):
            train.update([*tokens(text), None])
    n, v = sum(train.values()), len(train)
    return train, n, v


@pytest.mark.parametrize("hot", [0, 300, M.HOT_WORDS])
def test_scores_of_documents(spark, documents, rows, hot):
    model = M.learn(documents)
    train, n, v = brute(rows)
    assert (model.training_tokens, model.kinds) == (n, v)
    vocabulary = L.pieces(public_tokenizers.path(M.VOCABULARY))
    words = sorted({w for _, t in rows for w in tokens(t)})
    spelt = dict(zip(words, L.word_scores([w.encode() for w in words], vocabulary, np.log(model.weight)), strict=True))
    found = {r.doc_id: r for r in M.score(documents, model, hot).collect()}
    assert len(found) == len(rows)
    for i, text in rows:
        r, all_tokens = found[i], [*tokens(text), None]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(i), len(all_tokens), n)
        assert r.n_known == sum(train[t] > 0 for t in all_tokens)
        assert math.isclose(r.base_score, sum(math.log10((train[t] + 1) / (n + v + 1)) for t in all_tokens), rel_tol=1e-9)
        want = (sum(spelt[t] for t in all_tokens[:-1]) + math.log(model.weight[-1])) / math.log(10)
        assert math.isclose(r.score, want, rel_tol=1e-9)


def test_training_raises_the_probability_of_held_out_texts(spark, documents):
    totals = []
    for steps in (0, 1, 3):
        found = M.score(documents, M.learn(documents, steps=steps)).filter("held_out")
        totals.append(found.agg({"score": "sum"}).first()[0])
    assert totals[0] < totals[1] < totals[2] < 0


def test_a_group_of_copies_over_many_tasks(spark):
    copies = [(i, "Rare words here, rare Éclair") for i in range(300)] + [(900, "other words")]
    docs = spark.createDataFrame(copies, "doc_id bigint, text string").repartition(9)
    found = M.score(docs, M.learn(docs), 0).collect()
    assert len(found) == 301
    assert len({(r.n_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in found}) == 2


def test_odd_rows(spark, odd, none):
    model = M.learn(odd)
    found = M.score(odd, model).collect()
    assert len(found) == odd.count()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_tokens == by[2][0].n_tokens == by[3][0].n_tokens == 1
    assert by[1][0].score == by[3][0].score and by[6][0] == by[6][1]
    assert by[None][0].held_out is False and by[9][0].score < -10_000
    assert M.score(none, model).collect() == []
    empty = M.score(odd, M.learn(none)).collect()
    assert all(r.n_known == r.train_tokens == 0 and r.base_score == 0 and r.score < 0 for r in empty)
