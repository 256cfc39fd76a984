import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpus import awkward_rows, documents  # noqa: E402


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("awkward") / "documents.parquet")
    documents(spark, awkward_rows()).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return documents(spark, [])
