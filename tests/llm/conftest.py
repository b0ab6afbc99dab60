from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def awkward(spark):
    from helpers import AWKWARD, documents

    return documents(spark, AWKWARD).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    from helpers import documents

    return documents(spark, [])
