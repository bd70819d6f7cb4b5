"""Every registered query against its DuckDB text on the smallest tables that give rows."""

import pytest

import __spark_entry__ as driver
from creditloom.catalog import ORACLES, QUERIES
from creditloom.operators import models
from tests.check import compare, duck

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, key, monkeypatch):
    monkeypatch.setattr(models, "TREES", 30)  # every fit of the queries, in less time
    verdict = compare(spark, con, key, SF, QUERIES, ORACLES)
    if verdict == "EMPTY but equal":
        verdict = compare(spark, duck(LARGER), key, LARGER, QUERIES, ORACLES)
    assert verdict.startswith("ok" if key in ORACLES else "rows only"), verdict


def test_entry(spark):
    assert driver.entry(spark).limit(1).count() == 1
