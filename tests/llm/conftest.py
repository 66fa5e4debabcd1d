import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, score string, node string"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Rows (doc_id, text, source) as documents with more columns, some named like the operators' own."""

    def make(rows):
        full = [(i, t, None, s, None if t is None else len(t), 7, "x", None) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, repeated rows, one id with two texts."""
    long = " ".join(f"w{i % 977}é" for i in range(30_000))
    rows = [
        (1, None, "a"),
        (2, "", None),
        (3, " \n\t ", "a"),
        (4, "one two three", "b"),
        (4, "one two three", "b"),
        (5, long, "b"),
        (None, "no id here at all", "b"),
        (6, "x" * 5000, "c"),
        (7, "first text of seven", "c"),
        (7, "second text of seven", "c"),
    ]
    return make_docs(rows)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
