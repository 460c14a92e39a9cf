import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(scope="session")
def make(spark):
    """A table from rows; the schema is a DDL string."""

    def build(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)

    return build


DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use themselves.
CLASHING = "doc_id long, text string, lang string, n_tokens long, score double, cls long, ids string, key string, h long, point string"
