"""Driver contract and a DuckDB twin check on the smallest fixture (queries
whose output columns do not depend on the category set of the data)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from tillcast.sources.tables import TABLES

SF001 = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "DateKey" in df.columns and "SalesAmount" in df.columns


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:10]
    return v


@pytest.mark.parametrize("name", ["denorm_ml", "sample_rows", "seasonal_simple_weekly",
                                  "robust_scale", "label_encode", "decompose_additive", "acf",
                                  "multi_grain", "anderson_darling", "zip_dates"])
def test_matches_duckdb_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    sp = E.queries()[name](spark, SF001).toPandas()
    dd = con.execute(E.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    cols = sorted(sp.columns)

    def rows(pdf):
        out = []
        for rec in pdf[cols].astype(object).itertuples(index=False, name=None):
            out.append(tuple(_norm(None if (isinstance(x, float) and math.isnan(x)) or
                                   x is None or str(x) in ("<NA>", "NaT") else
                                   (float(x) if isinstance(x, (int, float)) and
                                    not isinstance(x, bool) else x)) for x in rec))
        return sorted(out, key=repr)
    assert rows(sp) == rows(dd)
