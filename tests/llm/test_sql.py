"""The queries that SQL can express, against their SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from agroloom.llm.queries import ORACLE_SQL, QUERIES

from ..sqlcheck import connect, rows

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_rows_equal_those_of_the_sql(spark, name):
    found, wanted = QUERIES[name](spark, SF_DIR).toPandas(), connect(SF_DIR).execute(ORACLE_SQL[name]).df()
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows(found) == rows(wanted)


def test_every_operator_has_its_query():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
