"""Outlier rules on tiny_sales: nulls, one row, ties, empty input."""

import numpy as np

from tillcast.operators import filters as flt


def _sales(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)],
                                 "id long, SalesAmount double")


def test_clean_outliers_threshold_and_nulls(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0, None, 5.0, 6.0]
    sd = np.std([v for v in vals if v is not None], ddof=1)
    kept = {r.id for r in flt.clean_outliers(_sales(spark, vals)).collect()}
    expect = {i for i, v in enumerate(vals) if v is not None and v <= 2.5 * sd}
    assert kept == expect and 5 not in kept


def test_clean_outliers_tie_is_kept(spark):
    vals = [0.0, 10.0]
    sd = float(np.std(vals, ddof=1))
    df = _sales(spark, vals + [2.5 * sd])
    # the appended value changes sigma; check the rule with the frame's own sigma
    all_vals = vals + [2.5 * sd]
    thr = 2.5 * float(np.std(all_vals, ddof=1))
    kept = [r.SalesAmount for r in flt.clean_outliers(df).collect()]
    assert kept == [v for v in all_vals if v <= thr]


def test_clean_outliers_one_row_and_empty(spark):
    assert flt.clean_outliers(_sales(spark, [5.0])).count() == 0  # sigma undefined
    empty = spark.createDataFrame([], "id long, SalesAmount double")
    assert flt.clean_outliers(empty).count() == 0


def test_zscore_and_quantile_rules(spark):
    rng = np.random.default_rng(0)
    vals = [float(v) for v in rng.normal(0, 1, 500)] + [8.0, -9.0]
    df = _sales(spark, vals)
    s = flt.zscore_summary(df).first()
    z = (np.array(vals) - np.mean(vals)) / np.std(vals)
    assert s.num_outliers == int((np.abs(z) > 2.5).sum())
    lo, hi = np.quantile(vals, [0.01, 0.99])
    got = {r.id for r in flt.outliers_quantile(df).collect()}
    assert got == {i for i, v in enumerate(vals) if v < lo or v > hi}
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    got = {r.id for r in flt.outliers_iqr(df).collect()}
    iqr = q3 - q1
    assert got == {i for i, v in enumerate(vals) if v < q1 - 1.5 * iqr or v > q3 + 1.5 * iqr}


def test_key_value_filter_validates(spark):
    df = _sales(spark, [1.0, 2.0])
    assert flt.key_value_filter(df, ["id"], ["1"]).count() == 1
    import pytest
    with pytest.raises(ValueError):
        flt.key_value_filter(df, ["nope"], [1])
