from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from check import session

    s = session()
    yield s
    s.stop()


@pytest.fixture(scope="session")
def con():
    from check import duck

    return duck(DATA)


@pytest.fixture(scope="session")
def tables(spark):
    from bazaarmill.sources.tables import Tables

    return Tables(spark, DATA)
