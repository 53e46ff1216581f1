import hashlib
import string
from collections import defaultdict

import numpy as np
import pytest

from starbrook.llm import exact_dedup as X

FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256((t or "").translate(FOLD).encode()).hexdigest()].append(i)
    out = []
    for sha, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 50, 5000])
def test_hash_is_perfect_and_minimal(n):
    digests = np.random.default_rng(n).integers(0, 256, (n, 32)).astype(np.uint8)
    displacement, slot = X.perfect_hash(digests)
    assert sorted(slot) == list(range(n))
    first, second, third = X._parts(digests)
    bucket = (third % np.uint64(len(displacement))).astype(np.int64)
    assert (X._slots(first, second, displacement[bucket], n) == slot).all()


def test_groups(documents, rows):
    assert sorted(map(tuple, X.exact_groups(documents).collect()), key=str) == brute(rows)


def test_odd_rows(odd, none):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, X.exact_groups(odd).collect()), key=str) == brute(rows)
    kept = X.drop_repeats(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 3, 4, 6, 7, 8, 9]
    assert X.exact_groups(none).collect() == [] and X.drop_repeats(none).collect() == []


def test_shards_follow_both_sides(spark, monkeypatch):
    """One small id that lies apart leaves a history of one digest, an empty history none."""
    monkeypatch.setattr(X, "SHARD_DIGESTS", 20)
    sizes = []

    def watched(index, asked, shards, own=X.match):
        sizes.append(asked.groupBy(X.shard_of(shards)).count().agg({"count": "max"}).first()[0])
        return own(index, asked, shards)

    monkeypatch.setattr(X, "match", watched)
    rows = [(-(10**12), "apart"), *((i, f"text {i % 300}") for i in range(400))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert X._deliveries(docs)[0].count() == 1
    assert sorted(map(tuple, X.exact_groups(docs).collect()), key=str) == brute(rows)
    digests = X._digests(docs)
    assert X.merged_groups(digests.limit(0), digests).count() == 301
    assert len(sizes) == 2 and max(sizes) <= 60


def test_history_and_delivery(spark):
    """Repeats of the history, and repeats within the delivery, at several shards."""
    history = spark.range(500).selectExpr("id as doc_id", "unhex(sha2(cast(id % 90 as string), 256)) as digest")
    new = spark.range(500, 900).selectExpr("id as doc_id", "unhex(sha2(cast(id % 130 as string), 256)) as digest")
    known = X._groups(history)
    found = X.match(X.build_index(known, 7), X._groups(new), 7).collect()
    want = {bytes(r.digest): (r.winner, r.n) for r in X._groups(history.union(new)).collect()}
    assert {bytes(r.digest): (r.winner, r.n) for r in found} == want and len(found) == len(want)
    empty = history.limit(0)
    assert X.merged_groups(empty, new).count() == X._groups(new).count()
    assert X.merged_groups(history, empty).count() == 90
