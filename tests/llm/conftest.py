import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture
def docs_of(spark):
    """A documents table from (doc_id, text) rows, with more columns, whose names clash with what operators add."""

    def make(rows):
        full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", "y") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "ids string, score string").repartition(3)

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
