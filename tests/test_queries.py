"""Every query of the core tables against its SQL, on the smallest test tables."""

import math
import os

import duckdb
import pytest

from trailmark.plans import catalogue

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):
    tidy = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(float(v), 6) if isinstance(v, (int, float)) else str(v)
    return sorted((tuple(tidy(v) for v in r) for r in rows), key=repr)


def test_every_query_has_sql():
    assert catalogue.QUERIES.keys() == catalogue.ORACLES.keys()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = db.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    assert plain(got.select(*columns).collect()) == plain(want.fetchall())
