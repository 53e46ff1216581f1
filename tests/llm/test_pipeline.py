import re

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from check import TABLES, rows_of
from starbrook.llm import exact_dedup, near_dedup, quality_rules, registry, toxicity

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(__spark_entry__.queries())
    assert {"pipeline", *registry.QUERIES} <= names
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")) == list(range(1, 14))


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_oracle(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = registry.QUERIES[name](spark, SF)
    result = db.execute(registry.ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


def test_stages(spark, tmp_path, monkeypatch):
    """Every stage keeps the columns, and just the rows that its operator's verdicts keep."""
    monkeypatch.setattr(corpus_pipeline, "scratch_path", lambda _, label: str(tmp_path / label))
    packed = corpus_pipeline.run(spark, SF, keep=True)
    verdicts = {
        "quality_rules": lambda d: quality_rules.judge(d, quality_rules.learn_from(spark, d, SF)).filter("kept"),
        "toxicity": lambda d: toxicity.score(d, toxicity.learn_from(spark, d, SF)).filter("predicted = 0"),
        "exact_dedup": lambda d: exact_dedup.exact_groups(d).filter("kept"),
        "near_dedup": lambda d: near_dedup.near_groups(d).filter("kept"),
    }
    before = first = spark.read.parquet(f"{SF}/documents.parquet")
    for name, _ in corpus_pipeline.STAGES[:-1]:
        after = spark.read.parquet(str(tmp_path / f"pipeline-{name}"))
        want = sorted(r.doc_id for r in verdicts[name](before).select("doc_id").collect())
        assert after.columns == first.columns
        assert sorted(r.doc_id for r in after.select("doc_id").collect()) == want
        before = after
    assert 0.6 * first.count() < before.count() < first.count()
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in before.collect()}


def test_empty_table(spark, documents, tmp_path):
    docs = documents.limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() == 0
