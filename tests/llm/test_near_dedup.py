import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from starbrook.llm import near_dedup as N
from starbrook.llm import sketch as S
from starbrook.llm.links import components


def bag(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[k : k + 5]) for k in range(max(min(1, len(words)), len(words) - 4)))


def similarity(a, b):
    common, union = sum((a & b).values()), sum((a | b).values())
    return common / union if union else 1.0


def brute(rows):
    bags = [bag(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= 0.8 - 1e-12:
                part[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    return sorted((i, min(g), len(g), i == min(g)) for g in groups.values() for i in g)


def copies(rng, n, families=6):
    words = [f"w{k}" for k in range(400)]
    bases = [[rng.choice(words) for _ in range(rng.randint(20, 200))] for _ in range(families)]
    rows = []
    for i in range(n):
        text = list(rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            text[rng.randrange(len(text))] = rng.choice(words)
        if rng.random() < 0.2:
            text = text + text[: rng.randint(1, len(text))]
        rows.append((i, " ".join(text)))
    return rows


def test_signature_estimates_weighted_similarity(monkeypatch):
    monkeypatch.setattr(S, "COMPONENTS", 512)
    rng, errors = np.random.default_rng(1), []
    for _ in range(25):
        pool = rng.integers(0, 1 << 40, 200)  # others in every trial
        a = Counter(rng.choice(pool, rng.integers(5, 300)).tolist())
        b = a.copy()
        for x in rng.choice(pool, 30):
            b[int(x)] += int(rng.integers(1, 9))
        items = [(0, x, w) for x, w in a.items()] + [(1, x, w) for x, w in b.items()]
        owner, value, weight = map(np.array, zip(*items, strict=True))
        signed = S.signatures(2, owner, S.mix(value.astype(np.uint64)), weight)
        errors.append(S.estimate(signed[0], signed[1]) - similarity(a, b))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.04


def test_signature_does_not_depend_on_company():
    texts = ["a b c d e f g", "x " * 50, "", "a b", "a b c d e f h"]
    alone = np.vstack([S.signatures(1, *S.shingles([t])) for t in texts])
    assert (S.signatures(len(texts), *S.shingles(texts)) == alone).all()


def test_shingles():
    owner, _, weight = S.shingles(["a b c d e f a b c d e", "", "A b", "a a a a a a a"])
    assert Counter(owner.tolist()) == {0: 6, 2: 1, 3: 1}
    assert sorted(weight[owner == 0]) == [1, 1, 1, 1, 1, 2] and weight[owner == 3].tolist() == [3]


def test_classes_against_all_pairs(spark, rows, documents):
    assert sorted(map(tuple, N.near_groups(documents).collect())) == brute(rows)
    made = copies(random.Random(7), 150)
    docs = spark.createDataFrame(made, "doc_id bigint, text string")
    assert sorted(map(tuple, N.near_groups(docs).collect())) == brute(made)


def test_buckets_of_many_blocks(spark, monkeypatch):
    """Blocks of four and two hubs: links across blocks must be found by the second search."""
    monkeypatch.setattr(N, "BLOCK", 4)
    monkeypatch.setattr(N, "HUBS", 1)
    monkeypatch.setattr(N, "SMALL", 2)
    made = copies(random.Random(8), 120, families=2)
    docs = spark.createDataFrame(made, "doc_id bigint, text string")
    assert sorted(map(tuple, N.near_groups(docs).collect())) == brute(made)


def test_odd_rows(odd, none):
    found = sorted((tuple(r) for r in N.near_groups(odd).collect()), key=str)
    by_id = {r[0]: r[1:] for r in found}
    assert len(found) == odd.count()
    assert by_id[1] == (1, 3, True) and by_id[2] == by_id[3] == (1, 3, False)
    assert by_id[5] == (5, 3, True) and by_id[6] == (5, 3, False)
    assert by_id[None] == (None, 1, True) and by_id[8][1] == 1
    kept = N.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 7, 8, 9]
    assert N.near_groups(none).collect() == [] and N.drop_copies(none).collect() == []


def test_components(spark):
    rng = random.Random(9)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    part = {x: x for p in pairs for x in p}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        part[b] = a
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    found = components(spark.createDataFrame(pairs, "u bigint, v bigint")).collect()
    assert {r.node: r.component for r in found} == {x: root(x) for x in linked} and len(found) == len(linked)
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


@pytest.mark.parametrize("ids", [(None, None, None), (4, 4, 4), (None, 4, 4), (None, 2, None)])
def test_one_of_a_class_stays_whatever_its_ids(spark, ids):
    body = " ".join(f"word{i}" for i in range(200))
    texts = [body, body + " more", "another " + body]
    docs = spark.createDataFrame([*zip(ids, texts, strict=True), (9, "something else")], "doc_id bigint, text string")
    kept = [tuple(r) for r in N.drop_copies(docs).collect()]
    assert len(kept) == 2 and (9, "something else") in kept
    groups = N.near_groups(docs).filter("class_size = 3").collect()
    least = min((i for i in ids if i is not None), default=None)
    assert [r.kept for r in groups].count(True) == 1 and {r.class_id for r in groups} == {least}
    assert next(r.doc_id for r in groups if r.kept) == least
