from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from documents import ODD, documents_schema, make_documents  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns with clashing names."""
    return make_documents(spark, ODD, clashes=True)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], documents_schema())


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
