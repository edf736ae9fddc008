import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from conftest_llm import ODD_TEXTS, SCHEMA, near_copies, rows  # noqa: E402


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts, repeat=0, nulls=True):
        data = rows(texts)
        if nulls:
            data += [(None, *r[1:]) for r in rows(["a text of no id, it has a few words", None])]
        data += data[:repeat]
        return spark.createDataFrame(data, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns."""
    return make_docs(ODD_TEXTS + near_copies(1, 40), repeat=12).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
