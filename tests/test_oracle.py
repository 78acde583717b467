"""Every query against its SQL twin; the others against their row count."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as contract
from billscope.plans.oracles import ORACLES
from billscope.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
ROWS_ONLY = {"quantile_edges_approx", "segments_kmeans", "segments_flow"}


@pytest.fixture(scope="module")
def connection():
    with oracle.connect(FOLDER) as opened:
        yield opened


def test_only_approximate_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, connection, name):
    frame = QUERIES[name](spark, FOLDER)
    assert oracle.difference(frame, connection, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_keeps_all_rows(spark, connection, name):
    expected = 4
    if name != "quantile_edges_approx":
        sql = ORACLES["segments_table" if name == "segments_flow" else "quarterly_mean_of_means"]
        expected = len(connection.execute(sql).fetchall())
    assert QUERIES[name](spark, FOLDER).count() == expected


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns and not frame.isEmpty()
