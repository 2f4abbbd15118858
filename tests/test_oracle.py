"""Every registered query against its SQL oracle, on whole tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, oracle_connection
from flowloom.plans.registry import collect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = collect()


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, oracle, name):
    assert compare(spark, oracle, SF, QUERIES[name], ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_has_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


# Rounding, ties and sizes that the smallest tables do not show.
@pytest.mark.parametrize("name", ["g1_flow_cells", "c4_flow_table_stats", "c10_summarise_dispatch", "d2_split_max_span", "d3_orient_tcp", "d4_conn_state_mixed"])
def test_query_equals_oracle_at_the_next_size(spark, name):
    folder = "/root/testdata/sf0.01"
    assert compare(spark, oracle_connection(folder), folder, QUERIES[name], ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
