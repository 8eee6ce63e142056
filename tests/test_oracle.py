"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import pytest

from tests.conftest import SF_SMALL

duckdb = pytest.importorskip("duckdb")

from __spark_entry__ import entry  # noqa: E402
from tools.oracle_check import TABLES, norm  # noqa: E402

from vigil.plans.oracle import ORACLE  # noqa: E402
from vigil.plans.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(cols)
    a = sorted(tuple(norm(r[cols.index(c)]) for c in order) for r in got)
    b = sorted(tuple(norm(r[ocols.index(c)]) for c in order) for r in exp)
    assert len(a) == len(b)
    assert a == b


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["rule_name", "rule_description", "n_events", "share_pct"]
    assert df.count() >= 1


def test_encode_events_rows(spark):
    df = QUERIES["encode_events"](spark, SF_SMALL)
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
