"""Every core query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from veritrail.plans import cases, configurations, registry, training

MODULES = (registry, cases, configurations, training)
QUERIES, ORACLES = ({k: v for m in MODULES for k, v in getattr(m, name).items()} for name in ("QUERIES", "ORACLES"))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    got, want = QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    text = lambda df: sorted(tuple(f"{v:.12g}" if isinstance(v, float) else str(v) for v in r) for r in df[columns].astype(object).itertuples(index=False))
    assert text(got) == text(want)
