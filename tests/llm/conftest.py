"""Fixtures of the operators' tests: a session with small partitions and batches."""

import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """frame(rows, schema, parts): rows dealt over a few partitions."""
    def make(rows, schema="doc_id long, text string", parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make


EDGE_TEXTS = [None, "", " ", "\n", "a", "one two", "tab\tand\x0bmore\r\n", "日本語 テキスト", "é" * 5000, "word " * 3000, "x" * 20000, "ümlaut ñandú!", "0"]


@pytest.fixture(scope="session")
def edge_rows():
    """Every edge text twice, once with a null id; the last id repeats."""
    rows = [(i, t) for i, t in enumerate(EDGE_TEXTS)] + [(100 + i, t) for i, t in enumerate(EDGE_TEXTS)] + [(None, t) for t in EDGE_TEXTS]
    return rows + [(7, "日本語 テキスト"), (7, "another text with the same id")]
