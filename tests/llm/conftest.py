from __future__ import annotations

import pytest

from tests.llm import brute


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(brute.awkward_rows(), brute.SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], brute.SCHEMA)
