import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DOCS = "doc_id long, text string, kept string, score string, bucket string"  # the last three clash with inner names


@pytest.fixture
def docs(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "x", "y", None) for i, t in rows], DOCS)

    return make
