"""Every registered query against its SQL oracle, over whole tables."""

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry_module
from matchwright.workload import oracles, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(queries.queries()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_oracle(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    assert set(entry_module.entry(spark).columns) == {"is_direct_match", "no_correction", "n"}
