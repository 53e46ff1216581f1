import re
from collections import defaultdict

import public_tokenizers
import pytest

from starbrook.llm import token_counts as T
from starbrook.llm.bpe import Ranks
from starbrook.llm.packing import Tokens

SF = "/root/testdata/sf0.001"
COLUMNS = "kind string, doc_id bigint, source string, lang string, text string, seq bigint, tokens int, docs string"


@pytest.fixture(scope="module")
def ranks():
    return Ranks.from_tokenizers(public_tokenizers.path(T.VOCABULARY))


def brute(ranks, texts):
    """Totals of doc_id -> (source, lang, text)."""
    own, sums = Tokens(ranks), defaultdict(lambda: [0, 0])
    for source, lang, text in texts.values():
        counts = {T.BPE: len(own.ids(text or "")), T.WORDS: len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))}
        for tokenizer, n in counts.items():
            sums[source, lang, tokenizer][0] += 1
            sums[source, lang, tokenizer][1] += n
    return {k: tuple(v) for k, v in sums.items()}


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in rollup.totals().collect()}


def test_query(spark, ranks):
    docs = {r.doc_id: (r.source, r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in spark.read.parquet(f"{SF}/labels.parquet").collect():
        source, lang, text = docs[r.doc_id]
        if r.quality == 0:
            docs[r.doc_id] = (source, lang, text.lower())
        if r.toxic == 1:
            del docs[r.doc_id]
    found = {(r.source, r.lang, r.tokenizer): (r.docs, r.tokens) for r in T.op8_token_counts(spark, SF).collect()}
    assert found == brute(ranks, docs)


def test_added_tokens_count_as_one(spark, ranks):
    rows = [("insert", 1, "a", "en", "a<|endoftext|>b", 0, 0, ""), ("insert", 2, "a", "en", "<|endoftext|>" * 3, 0, 0, "")]
    found = T.count_tokens(spark.createDataFrame(rows, COLUMNS), ranks).collect()
    assert {r.doc_id: r.tokens for r in found} == {1: 3, 2: 3}


def test_batches(spark, ranks, tmp_path):
    rollup = T.Rollup(spark, str(tmp_path / "rollup"), ranks)
    assert totals(rollup) == {}

    def commit(number, rows):
        return rollup.commit(number, spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS))

    assert commit(1, [("insert", 1, "a", "en", "one two", 0), ("insert", 2, "a", None, None, 0),
                      ("insert", 3, None, "en", "x " * 5000, 0), ("insert", None, "a", "en", "lost", 0),
                      ("insert", 4, "b", "de", "", None), ("insert", 4, "b", "de", "", None)])
    state = {1: ("a", "en", "one two"), 2: ("a", None, None), 3: (None, "en", "x " * 5000), 4: ("b", "de", "")}
    assert totals(rollup) == brute(ranks, state)
    # a committed number changes nothing, whatever it carries
    assert not commit(1, [("delete", 1, "a", "en", None, 0)])
    # moved and revised; deleted; unknown ones deleted and revised; the last change of a batch counts
    assert commit(2, [("revise", 1, "c", "fr", "one two three", 5), ("delete", 1, "a", "en", None, 4),
                      ("delete", 3, None, "en", None, 0), ("delete", 99, "a", "en", None, 0),
                      ("revise", 7, "a", "en", "new", 0), ("insert", 2, "a", None, "again", 0)])
    state = {1: ("c", "fr", "one two three"), 2: ("a", None, "again"), 4: ("b", "de", ""), 7: ("a", "en", "new")}
    assert totals(rollup) == brute(ranks, state)
    assert commit(3, []) and totals(rollup) == brute(ranks, state)
    assert commit(4, [("delete", i, "?", "?", None, 0) for i in state]) and totals(rollup) == {}


def test_a_small_batch_reads_its_parts(spark, ranks, tmp_path):
    rollup = T.Rollup(spark, str(tmp_path / "rollup"), ranks, parts=16)

    def changes(rows):
        return spark.createDataFrame([(*r, 0, 1, "x") for r in rows], COLUMNS)

    rollup.commit(1, changes([("insert", i, "a", "en", f"text {i}") for i in range(400)]))
    rollup.commit(2, changes([("revise", i, "b", "en", "less") for i in (3, 5)]))
    docs = spark.createDataFrame([(3,), (999,)], "doc_id bigint")
    touched = {r.part for r in docs.select(rollup._part().alias("part")).collect()}
    read = rollup._signed(sorted(touched))
    assert "PartitionFilters: [part" in read._jdf.queryExecution().executedPlan().toString()
    # 16 parts of 800 rows, and two changes
    assert read.count() < 400 and {r.part for r in read.select("part").collect()} <= touched
    found = {(r.doc_id, r.source, r.tokenizer, r.docs) for r in rollup.on_record(docs).collect()}
    assert found == {(3, "b", T.BPE, 1), (3, "b", T.WORDS, 1)}
    plan = rollup.on_record(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and rollup.on_record().count() == 800


def test_fold(spark, ranks, tmp_path, monkeypatch):
    rollup = T.Rollup(spark, str(tmp_path / "rollup"), ranks, parts=4)
    state = {}

    def commit(number, rows):
        for kind, doc, source, text in rows:
            state[doc] = (source, "en", text)
            if kind == "delete":
                del state[doc]
        changes = [(kind, doc, source, "en", text, 0, 1, "x") for kind, doc, source, text in rows]
        return rollup.commit(number, spark.createDataFrame(changes, COLUMNS))

    rollup.fold()  # of nothing
    assert totals(rollup) == {}
    commit(1, [("insert", i, "a", "one " * i) for i in range(9)])
    commit(2, [("revise", 3, "b", "three"), ("delete", 4, "a", None)])
    with monkeypatch.context() as patched:  # lost before its row is there
        patched.setattr(spark, "createDataFrame", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            rollup.fold()
    assert totals(rollup) == brute(ranks, state)
    rollup.fold()
    assert totals(rollup) == brute(ranks, state)
    assert rollup._signed().count() == 2 * len(state)  # revised and deleted rows are gone
    assert not rollup.commit(2, spark.createDataFrame([("delete", 1, "a", "en", None, 0, 1, "x")], COLUMNS))
    commit(7, [("delete", 3, "b", None), ("insert", 20, "c", "new"), ("revise", 1, "a", "")])
    commit(5, [("revise", 20, "c", "newer still")])
    assert totals(rollup) == brute(ranks, state)
    rollup.fold()
    assert totals(rollup) == brute(ranks, state) and rollup._signed().count() == 2 * len(state)


def test_broken_attempt_is_not_read(spark, ranks, tmp_path, monkeypatch):
    rollup = T.Rollup(spark, str(tmp_path / "rollup"), ranks)
    rows = spark.createDataFrame([("insert", 1, "a", "en", "one two", 0, 1, "x")], COLUMNS)

    class Lost(Exception):
        pass

    def fails(*_):
        raise Lost

    with monkeypatch.context() as patched:
        patched.setattr(spark, "createDataFrame", fails)
        with pytest.raises(Lost):
            rollup.commit(1, rows)
    assert totals(rollup) == {}
    assert rollup.commit(1, rows) and totals(rollup) == brute(ranks, {1: ("a", "en", "one two")})
