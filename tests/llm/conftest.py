import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from conftest_llm import DOCUMENT, edge_rows  # noqa: E402


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty and very long texts, ties, repeats and columns with clashing names."""
    return spark.createDataFrame(edge_rows(), DOCUMENT).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)
