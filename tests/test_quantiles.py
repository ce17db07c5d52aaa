"""Quantiles by selection: narrow sketches, ties, nan, nulls and many ranks."""

import numpy as np
import pytest

from tillcast.operators import quantiles as Q


def frame(spark, seed, n):
    rng = np.random.default_rng(seed)
    cols = {"ties": rng.integers(0, 5, n).astype(float), "normal": rng.normal(0, 1e6, n), "skew": np.exp(rng.normal(0, 3, n)),
            "same": np.full(n, 2.5), "half": np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n))}
    rows = list(zip(*[c.tolist() for c in cols.values()], strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(5)
    return df, cols


@pytest.mark.parametrize(("accuracy", "keep", "brackets"), [(5000, 20000, 240), (20, 300, 7)])
def test_selection_is_exact(spark, monkeypatch, accuracy, keep, brackets):
    monkeypatch.setattr(Q, "SMALL_VALUES", 0)
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "KEEP", keep)
    monkeypatch.setattr(Q, "BRACKETS", brackets)
    df, cols = frame(spark, 3, 1501)
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = Q.quantiles(df, list(cols), probs)
    for c, v in cols.items():
        s, want = np.sort(v), []
        for p in probs:
            h = (len(s) - 1) * p
            a, b = s[int(h)], s[min(int(h) + 1, len(s) - 1)]
            want.append(a + (h - int(h)) * (b - a))
        assert got[c] == want, c


def test_wrong_sketches_only_cost_rounds(spark, monkeypatch):
    """The counts decide, not the sketch."""
    monkeypatch.setattr(Q, "SMALL_VALUES", 0)
    df, cols = frame(spark, 4, 500)
    right = Q._round
    given = []

    def wrong(df, brackets, found, ends=None):
        if ends is not None:
            given.append(len(ends))
            ends = [[5.0, 5.0]] * len(ends)
        return right(df, brackets, found, ends)

    monkeypatch.setattr(Q, "_round", wrong)
    assert Q.quantiles(df, ["normal"], [0.5])["normal"] == [float(np.sort(cols["normal"])[249:251].mean())] and given


def test_nulls_nan_and_integers(spark, monkeypatch):
    for small in (0, 1000):
        monkeypatch.setattr(Q, "SMALL_VALUES", small)
        df = spark.createDataFrame([(1, 1.0, None), (2, float("nan"), None), (None, 3.0, None), (4, None, None)], "i int, x double, n double")
        got = Q.quantiles(df, ["i", "x", "n"], [0.0, 0.5, 1.0])
        assert got["i"] == [1.0, 2.0, 4.0] and got["n"] is None
        assert got["x"][:2] == [1.0, 3.0] and np.isnan(got["x"][2])      # nan is the largest value
        assert Q.quantiles(df.limit(0), ["i"], [0.5]) == {"i": None}
    assert Q.quantiles(df, [], [0.5]) == {}


def test_plan_has_no_unpivot_or_sort(spark):
    df = spark.range(100).selectExpr("cast(id as double) AS a", "id * 2 AS b")
    values = [Q._value(df, c) for c in ("a", "b")]
    from pyspark.sql import functions as F
    plan = df.agg(*[F.percentile_approx(v, Q._points(0.5, 0.5), Q.ACCURACY) for v in values])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Sort " not in plan and "rangepartitioning" not in plan
