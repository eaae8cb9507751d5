import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import edge  # noqa: E402


@pytest.fixture(scope="session")
def docs(spark):
    return edge.documents(spark).cache()


@pytest.fixture(scope="session")
def plain(spark):
    """The same rows without the further columns."""
    return edge.documents(spark, clash=False).cache()
