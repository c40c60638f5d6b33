"""Every registered query against its SQL twin, over whole tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlens.catalog.all import REGISTRY
from tests.compare import differences, oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    got = queries()[name](spark, FOLDER).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        assert differences(got, con.execute(sql).df()) is None


def test_entry(spark):
    report = entry(spark)
    assert {"category", "baseline", "current", "shift", "flagged"} <= set(report.columns)
    rows = report.collect()
    assert len(rows) > 1
    assert sum(r["baseline"] for r in rows) == pytest.approx(1) and sum(r["current"] for r in rows) == pytest.approx(1)
