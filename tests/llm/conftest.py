import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))  # tests share fixtures


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents with null and clashing columns, from (doc_id, text) pairs."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, None, "part", 1) for i, t in rows],
            "doc_id long, text string, lang string, block string, n int")
    return make
