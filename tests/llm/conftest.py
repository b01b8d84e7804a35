import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_cases import EDGE_ROWS  # noqa: E402


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Edge cases with an extra column, and columns named like the operators' own."""
    return spark.createDataFrame([(*row, 1, "n", "k") for row in EDGE_ROWS],
                                 "doc_id long, text string, source string, part long, node string, key string").repartition(3)


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
