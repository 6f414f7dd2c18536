"""Every query with SQL gives the SQL's rows; the others run and give rows."""

import os

import pytest

from genoflux.plans.queries import ORACLE_SQL, QUERIES

from .oracle import same

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are absent")


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    same(spark, QUERIES[name], ORACLE_SQL[name], FOLDER)


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1
