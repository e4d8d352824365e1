from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpora  # noqa: E402


@pytest.fixture
def odd(spark):
    return corpora.documents(spark).repartition(3)


@pytest.fixture
def none(spark):
    return corpora.documents(spark, [])
