"""Session and tables of the training-data tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from balcao.llm.package import ship  # noqa: E402
from conftest_llm import EXTRA, SCHEMA, corpus  # noqa: E402


@pytest.fixture(scope="session")
def spark(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), *EXTRA) for i, t, s in corpus()], SCHEMA)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("1 = 0")
