import os

import pytest
from odd import odd_rows

SF = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents with clashing further columns."""
    rows = [(i, t, "piece", "key", 7) for i, t in odd_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, piece string, key string, length int")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
