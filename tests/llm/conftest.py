import pytest

SF = "/root/testdata/sf0.001"
ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "one"),
    (5, "One two three four"),
    (6, "one two three four"),
    (6, "one two three four"),
    (None, "no id at all"),
    (7, "é😀 ÀB " * 3),
    (8, "long " * 30_000),
    (9, "x" * 100_000),
]


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    return [(r.doc_id, r.text) for r in documents.collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named as operators name theirs."""
    columns = "doc_id bigint, text string, label string, kept int, row string, k0 int, _row int, node int, score int"
    return spark.createDataFrame([(i, t, "a", 1, "b", 2, 3, 4, 5) for i, t in ODD_TEXTS], columns)


@pytest.fixture(scope="session")
def none(spark, odd):
    return odd.limit(0)
