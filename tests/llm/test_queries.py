"""Registered corpus queries: SQL where there is some, else whole results."""

import os

import pytest

import __spark_entry__
from genoflux.llm.registry import ORACLE_SQL, QUERIES

from ..oracle import connect, same

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are absent")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name], FOLDER)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_every_document(spark, name):
    n = connect(FOLDER).execute("SELECT count(*) FROM documents").fetchall()[0][0]
    assert QUERIES[name](spark, FOLDER).select("doc_id").distinct().count() == n


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} <= {k.split("_")[0] for k in __spark_entry__.queries()} and "pipeline" in __spark_entry__.queries()
