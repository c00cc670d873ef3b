"""Every registered query against its SQL twin at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry_points
from pricelake.plans.oracle import ORACLE
from pricelake.plans.registered import QUERIES
from tools.compare import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_flagship(spark):
    assert entry_points.entry(spark).count() == 150


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    same, _, _, note = compare(spark, con, SF_DIR, name)
    assert same, note
