"""The star's large join shuffles the line items' own columns; the fact's columns
are computed after it."""

import re

from tillcast.operators import joins
from tillcast.plans.star import denorm_ml

SF001 = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().sparkPlan().toString()


def test_orders_join_is_shuffled_before_the_fact_is_computed(spark, monkeypatch):
    monkeypatch.setattr(joins, "GROWING_BYTES", 0)
    optimized, physical = _plan(denorm_ml(spark, SF001))
    assert "SortMergeJoin" in physical
    lines = optimized.splitlines()
    join = next(i for i, line in enumerate(lines) if re.search(r"Join LeftOuter, \(l_orderkey", line))
    assert not any("concat_ws" in line for line in lines[join:])      # the sales key
    assert any("concat_ws" in line for line in lines[:join])


def test_sample_keeps_its_rows(spark):
    whole = {r.SalesKey: r.SalesAmount for r in denorm_ml(spark, SF001, columns=["SalesKey", "SalesAmount"]).collect()}
    some = denorm_ml(spark, SF001, ratio=0.5, columns=["SalesKey", "SalesAmount", "StoreType"]).collect()
    assert 0.4 * len(whole) < len(some) < 0.6 * len(whole)
    assert all(whole[r.SalesKey] == r.SalesAmount for r in some)
