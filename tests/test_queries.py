"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from check_oracles import connect, differences

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def twin():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_matches_sql(spark, twin, name):
    frame = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert frame.count() > 0
    else:
        assert differences(frame, twin, sql) == []


def test_entry_is_the_drift_report(spark):
    rows = contract.entry(spark).collect()
    assert [r.drift_score for r in rows] == sorted([r.drift_score for r in rows], reverse=True)
    assert {r.feature for r in rows} == {"l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"}


def test_every_twin_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
