"""Exact-likelihood SARIMA: against the likelihood from covariance matrices, a
grid search of it, simulated orders, and the full grid of orders."""

import datetime as dt
import math

import numpy as np
import pytest

from tillcast.operators import sarima as S


def simulate(ar, ma, n, seed, d=0):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + 300)
    u = np.zeros(n + 300)
    for t in range(len(u)):
        u[t] = e[t] + sum(c * u[t - i] for i, c in enumerate(ar, 1) if t >= i) + sum(c * e[t - i] for i, c in enumerate(ma, 1) if t >= i)
    u = u[300:]
    for _ in range(d):
        u = np.cumsum(u)
    return u


def covariance_loss(z, ar, ma, seen=None):
    """-2 log likelihood with the variance profiled out, from the Toeplitz
    covariance of the infinite moving average (long enough to be exact)."""
    long = 4000
    psi = np.zeros(long)
    psi[0] = 1
    for t in range(1, long):
        psi[t] = (ma[t - 1] if t <= len(ma) else 0) + sum(ar[i - 1] * psi[t - i] for i in range(1, min(t, len(ar)) + 1))
    gamma = np.array([psi[:long - k] @ psi[k:] for k in range(len(z))])
    at = np.arange(len(z)) if seen is None else np.flatnonzero(seen)
    C = gamma[np.abs(at[:, None] - at[None, :])]
    L = np.linalg.cholesky(C)
    v = np.linalg.solve(L, z[at])
    n = len(at)
    return n * (math.log(2 * math.pi) + 1) + n * math.log(v @ v / n) + 2 * np.log(np.diag(L)).sum()


@pytest.mark.parametrize(("ar", "ma"), [([0.6], []), ([], [0.5]), ([0.5, -0.3], [0.4]), ([0.9], [-0.6, 0.2]), ([0, 0, 0, 0.5], [0.3])])
def test_likelihood_is_exact(ar, ma):
    z = simulate(ar, ma, 120, 3)
    got = S.filtered(z, np.zeros((120, 0)), np.array([ar]).reshape(1, -1), np.array([ma]).reshape(1, -1)).loss[0]
    assert abs(got - covariance_loss(z, ar, ma)) < 1e-6
    gaps = z.copy()
    gaps[[4, 5, 50, 119]] = np.nan
    got = S.filtered(gaps, np.zeros((120, 0)), np.array([ar]).reshape(1, -1), np.array([ma]).reshape(1, -1)).loss[0]
    assert abs(got - covariance_loss(z, ar, ma, ~np.isnan(gaps))) < 1e-6


def refine(loss, x, width):
    """Grid search, ever finer."""
    x = np.array(x, float)
    while width > 1e-5:
        grid = np.stack(np.meshgrid(*[c + width * np.linspace(-1, 1, 11) for c in x]), -1).reshape(-1, len(x))
        grid = grid[(np.abs(grid) < 0.995).all(1)]
        x = grid[np.argmin([loss(*g) for g in grid])]
        width /= 4
    return x


def test_ma1_and_arma11_against_a_grid_search():
    z = simulate([], [0.6], 90, 1)
    fit = S.fit_sarima(z, S.Order(p=0, q=1, trend="n"))
    want = refine(lambda b: covariance_loss(z, [], [b]), [0.0], 0.9)
    assert abs(fit.ma[0] - want[0]) < 1e-3
    z = simulate([0.7], [-0.4], 90, 2)
    fit = S.fit_sarima(z, S.Order(p=1, q=1, trend="n"))
    want = refine(lambda a, b: S.filtered(z, np.zeros((90, 0)), np.array([[a]]), np.array([[b]])).loss[0], [0.0, 0.0], 0.9)
    assert abs(fit.ar[0] - want[0]) < 1e-3 and abs(fit.ma[0] - want[1]) < 1e-3


def test_regression_is_profiled():
    u = simulate([0.5], [], 400, 4)
    y = 10 + 0.2 * np.arange(1, 401) + u
    fit = S.fit_sarima(y, S.Order(p=1, trend="ct"))
    assert abs(fit.beta[0] - 10) < 1.0 and abs(fit.beta[1] - 0.2) < 0.01 and abs(fit.ar[0] - 0.5) < 0.12
    assert S.fit_sarima(np.full(50, 3.0), S.Order()) is None and S.fit_sarima(np.arange(3.0), S.Order(p=2, q=2)) is None


def test_partial_autocorrelations_round_trip():
    x = np.random.default_rng(0).normal(size=(50, 4))
    for row in x:
        a = S.from_partial(row[None, :])[0]
        inside = np.abs(np.tanh(row)).max() < 0.94
        assert np.abs(np.roots(np.r_[-a[::-1], 1.0])).min() > 1 - 1e-9
        if inside:
            assert np.allclose(S.to_partial(a), row, atol=1e-8)


def test_seasonal_product():
    ar, ma = S.polynomials(np.array([[0.3, 0.2, 0.4, 0.1]]), S.Order(1, 0, 1, 1, 0, 1, 4))
    phi, theta, Phi, Theta = (S.EDGE * np.tanh(v) for v in (0.3, 0.2, 0.4, 0.1))
    assert np.allclose(ar, [[phi, 0, 0, Phi, -phi * Phi]])
    assert np.allclose(ma, [[-theta, 0, 0, -Theta, theta * Theta]])


def test_forecast_of_simulated_paths_is_covered():
    """95 % intervals of an ARIMA(1,1,1) hold about that share of the future."""
    inside = total = 0
    for seed in range(30):
        y = simulate([0.5], [0.3], 220, seed, d=1)
        fit = S.fit_sarima(y[:200], S.Order(1, 1, 1, trend="n"))
        mean, se = S.forecast(fit, y[:200], 20)
        inside += int((np.abs(y[200:] - mean) <= S.Z95 * se).sum())
        total += 20
    assert 0.85 <= inside / total <= 0.99


def test_forecast_by_hand():
    y = np.r_[simulate([], [0.5], 80, 6), 0.0]
    fit = S.fit_sarima(y, S.Order(p=0, q=1, trend="n"))
    mean, se = S.forecast(fit, y, 3)
    assert abs(mean[1]) < 1e-9 and abs(mean[2]) < 1e-9
    assert np.allclose(se, np.sqrt(fit.sigma2 * np.cumsum([1, fit.ma[0] ** 2, 0])))


@pytest.mark.parametrize(("ar", "ma", "d"), [([0.7], [], 0), ([], [0.6], 0), ([0.5, 0.3], [], 0), ([0.6], [0.4], 1), ([], [0.5, 0.3], 1)])
def test_stepwise_search_finds_the_grids_aic(ar, ma, d):
    y = simulate(ar, ma, 250, 11, d)
    step, tried = S.search_order(y, max_p=2, max_q=2)
    grid, every = S.search_order(y, max_p=2, max_q=2, stepwise=False)
    assert step.order.d == d and tried <= every
    assert step.aic <= grid.aic + 2


def test_season_is_differenced():
    rng = np.random.default_rng(2)
    y = 10 * np.sin(2 * np.pi * np.arange(120) / 12) + rng.normal(size=120)
    assert S.choose_differences(y, 12, 2, 1)[1] == 1
    assert S.choose_differences(rng.normal(size=120), 12, 2, 1) == (0, 0)
    assert S.choose_differences(np.cumsum(rng.normal(size=300)), 1, 2, 0)[0] == 1


def frame(spark):
    rows = []
    for k, (ar, ma) in {"a": ([0.6], []), "b": ([], [0.5])}.items():
        base = dt.date(2000, 1, 1)
        y = simulate(ar, ma, 120, 5)
        rows += [(k, base + dt.timedelta(days=7 * i), float(np.exp(0.1 * v + 3))) for i, v in enumerate(y) if i not in (7, 8, 60)]
        rows += [(k, base, 0.0), (k, None, 5.0)]
    rows += [("short", dt.date(2000, 1, 1), 1.0), ("flat", dt.date(2000, 1, 1), 2.0), ("flat", dt.date(2000, 1, 8), 2.0), ("null", dt.date(2000, 1, 1), None)]
    return spark.createDataFrame(rows, "k string, ds date, y double")


def test_operators(spark):
    df = frame(spark)
    out = S.sarima_forecast(df, "y", "ds", ["k"], S.Order(1, 0, 1), horizon=4, log=True, step="week").collect()
    assert {r.k for r in out} == {"a", "b"} and len(out) == 8
    assert all(0 < r.lo < r.yhat < r.hi and (r.p, r.d, r.q) == (1, 0, 1) for r in out)
    assert sorted(str(r.ds) for r in out if r.k == "a")[0] == str(dt.date(2000, 1, 1) + dt.timedelta(days=7 * 120))
    best = {r.k: r for r in S.sarima_search(df, "y", "ds", ["k"], log=True, step="week", max_p=1, max_q=1).collect()}
    assert set(best) == {"a", "b"} and all(r.tried <= 8 for r in best.values())
    test = S.sarima_backtest(df, "y", "ds", ["k"], S.Order(1, 0, 1), log=True, step="week").collect()
    assert all(r.n_train == 84 and 0 <= r.covered <= 1 for r in test)
    coefs = S.sarima_coefficients(df, "y", "ds", ["k"], S.Order(0, 0, 1), log=True, step="week")
    assert {(r.k, r.name, r.lag) for r in coefs.collect()} == {(k, n, i) for k in "ab" for n, i in (("ma", 1), ("beta", 0), ("sigma2", 0))}
    assert S.sarima_forecast(df.limit(0), "y", "ds", ["k"]).count() == 0
