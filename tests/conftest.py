import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import oracle  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return oracle.session()


@pytest.fixture(scope="session")
def tables(spark):
    from larkspur.plans.registry import Tables

    return Tables(spark, FOLDER)


@pytest.fixture(scope="session")
def run(spark):
    from larkspur.plans.catalogue import CATALOGUE

    def rows(name):
        return CATALOGUE[name](spark, FOLDER).collect()

    return rows


@pytest.fixture(scope="session")
def duck():
    return oracle.duck(FOLDER)
