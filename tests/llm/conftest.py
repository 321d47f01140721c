import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from brute import corpus  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, _id string, _text int, _tx string, kept string, n_words string, shard string, length string"


@pytest.fixture(scope="session")
def docs():
    return corpus()


@pytest.fixture(scope="session")
def table(spark, docs):
    """The corpus with extra columns whose names the operators use inside."""
    rows = [(d, t, "en" if t and len(t) % 2 else None, "z", 1, "z", "z", "z", "z", "z") for d, t in docs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
