"""Every query that has a SQL twin gives the twin's rows."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from vigilseries.plans.catalog import QUERIES
from vigilseries.plans.oracles import ORACLES

SF = "/root/testdata/sf0.001"
TABLES = ("events", "documents", "embeddings", "labels")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def test_twins_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLES[name]).df()
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns) and len(ours) == len(theirs)
    by = [c for c in cols if ours[c].dtype.kind != "f"] or cols
    a, b = (x[cols].sort_values(by, ignore_index=True) for x in (ours, theirs))
    for c in cols:
        if a[c].dtype.kind == "f" or b[c].dtype.kind == "f":
            np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), atol=2e-6, err_msg=c)
        else:
            assert ((a[c] == b[c]) | (a[c].isna() & b[c].isna())).all(), c


def test_entry(spark):
    df = entry.entry(spark)
    assert len([c for c in df.columns if c not in ("event_id", "row_idx", "is_anomaly", "anomaly_type")]) == 113
    assert df.count() == 970
