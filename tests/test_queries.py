"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from agroloom.plans.queries import ORACLE_SQL, QUERIES

from .sqlcheck import connect, rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def sql():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_rows_equal_those_of_the_sql(spark, sql, name):
    found, wanted = QUERIES[name](spark, SF_DIR).toPandas(), sql.execute(ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


@pytest.mark.parametrize("name", ["grid_to_geojson", "pixel_scoring", "classifier_kfold", "classifier_test", "feature_importance"])
def test_queries_without_sql_give_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
