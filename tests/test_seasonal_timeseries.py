"""Grain aggregation properties and time-series identities (tiny_series)."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import seasonal as sea
from tillcast.operators import timeseries as ts
from tillcast.functions.calendar import with_calendar


def _rows(spark, n=60):
    start = dt.date(1999, 12, 1)
    data = [(start + dt.timedelta(days=i % 40), float(i), float(i % 7)) for i in range(n)]
    df = spark.createDataFrame(data, "DateKey date, SalesAmount double, UnitCost double")
    return with_calendar(df, "DateKey", ["CalendarYear", "CalendarWeekLabel", "MonthNumber",
                                         "CalendarQuarterLabel"])


def test_grain_totals_equal_overall_total(spark):
    df = _rows(spark)
    total = df.agg(F.sum("SalesAmount")).first()[0]
    for g in ("daily", "weekly", "monthly", "quarterly", "yearly"):
        got = sea.seasonalize_y(df, g).agg(F.sum("SalesAmount")).first()[0]
        assert math.isclose(got, total)
    mg = sea.multi_grain(df, {"SalesAmount": "sum"})
    for g in ("daily", "weekly", "monthly", "quarterly", "yearly"):
        got = mg.where(F.col("grain") == g).agg(F.sum("SalesAmount")).first()[0]
        assert math.isclose(got, total)


def test_null_rules(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 1), None), (None, 5.0)],
                               "DateKey date, SalesAmount double")
    out = sea.seasonalize_y(df, "daily").collect()
    assert len(out) == 1 and out[0].SalesAmount == 0.0  # all-null sum is 0; null key dropped


def _series(spark):
    # two series, a gap day in "b", a non-positive value for ln
    rows = []
    base = dt.date(2020, 1, 1)
    for i in range(14):
        rows.append(("a", base + dt.timedelta(days=i), 10.0 + (i % 4) + 0.5 * i))
    for i in range(14):
        if i == 5:
            continue
        rows.append(("b", base + dt.timedelta(days=i), float(i % 3) - 0.5))
    return spark.createDataFrame(rows, "series_id string, ds date, y double")


@pytest.mark.parametrize("period", [4, 5])
def test_decompose_identity(spark, period):
    df = _series(spark)
    add = ts.decompose(df, "y", "ds", ["series_id"], period=period).where(
        F.col("trend").isNotNull()).collect()
    assert add
    for r in add:
        assert math.isclose(r.trend + r.seasonal + r.resid, r.y, abs_tol=1e-9)
    a = [r for r in ts.decompose(df, "y", "ds", ["series_id"], period=period).collect()
         if r.series_id == "a"]
    ys = np.array([r.y for r in sorted(a, key=lambda r: r.ds)])
    half = period // 2
    if period % 2:
        expect = np.convolve(ys, np.ones(period) / period, mode="valid")
    else:
        w = np.r_[0.5, np.ones(period - 1), 0.5] / period
        expect = np.convolve(ys, w, mode="valid")
    got = [r.trend for r in sorted(a, key=lambda r: r.ds)][half:half + len(expect)]
    np.testing.assert_allclose(got, expect)
    seas = {r.phase: r.seasonal for r in a}
    assert math.isclose(sum(seas.values()), 0.0, abs_tol=1e-9)


def test_diff_backfill_and_log_split(spark):
    df = _series(spark).where(F.col("series_id") == "a")
    d = ts.diff_backfill(df, "y", "ds").orderBy("ds").collect()
    assert d[0].diff == d[1].diff
    sp = ts.chrono_split_series(_series(spark), "ds", ["series_id"], 0.7, as_log=True, y="y")
    b = sp.where(F.col("series_id") == "b").orderBy("ds").collect()
    assert sum(r.is_train for r in b) == round(0.7 * 13)  # 9.1 -> 9
    assert all((r.log_y is None) == (r.y <= 0) for r in b)


def test_acf_pacf_of_ar1(spark):
    rng = np.random.default_rng(3)
    y = np.zeros(600)
    for t in range(1, 600):
        y[t] = 0.6 * y[t - 1] + rng.normal()
    base = dt.date(2000, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(days=i), float(v)) for i, v in enumerate(y)],
                               "DateKey date, SalesAmount double")
    acf = {r.lag: r.acf for r in ts.acf(df, nlags=5).collect()}
    e = y - y.mean()
    assert math.isclose(acf[0], 1.0)
    assert math.isclose(acf[2], float((e[:-2] * e[2:]).sum() / (e * e).sum()), rel_tol=1e-9)
    pacf = {r.lag: r.pacf for r in ts.pacf(df, nlags=5).collect()}
    assert abs(pacf[1] - 0.6) < 0.1 and abs(pacf[3]) < 0.1


def test_lag_rows_two_level(spark):
    from tillcast.operators.ranking import lag_rows
    from tillcast.operators.ranking import global_row_number
    df = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("y"))
    out = lag_rows(df, "y", ["k"]).collect()
    assert len(out) == 199 and all(r.y - r.y_pred == 2.0 for r in out)
    r = global_row_number(df, ["k"], force_distributed=True).agg(F.max("rn")).first()[0]
    assert r == 200


def test_divisions_by_zero_are_null(spark):
    rows = [("c", dt.date(2020, 1, 1) + dt.timedelta(days=i), 0.0) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, ds date, y double")
    assert [r.acf for r in ts.acf(df, "y", "ds", ["k"], nlags=2).collect()] == [None] * 3
    mult = ts.decompose(df, "y", "ds", ["k"], period=3, model="multiplicative")
    assert mult.where("seasonal IS NOT NULL OR resid IS NOT NULL").count() == 0
    assert ts.deseasonalize(mult, "y").where("deseasonalized IS NOT NULL").count() == 0
    from tillcast.operators.profile import anderson_darling
    assert anderson_darling(df, "y").where("statistic IS NOT NULL").count() == 0


def test_weeks_never_join_both_ends_of_a_year(spark):
    from tillcast.functions.calendar import date_spine
    days = with_calendar(date_spine(spark, "1995-01-01", "2012-12-31"), "DateKey", ["CalendarYear", "CalendarWeekLabel"])
    week = days.groupBy("CalendarYear", "CalendarWeekLabel").agg(
        F.count("*").alias("n"), F.datediff(F.max("DateKey"), F.min("DateKey")).alias("span"), F.countDistinct(F.date_trunc("week", "DateKey")).alias("mondays"))
    assert week.where("n <> span + 1 OR mondays > 1 OR n > 7").count() == 0
