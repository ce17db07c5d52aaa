"""Seasonal ARIMA by exact likelihood, with moving-average terms, and its order
search; each series is one ``applyInPandas`` group.

Model: the series (optionally its logarithm) is differenced d times, and D
times over m steps; what is left is a regression on a constant or a line with
errors that follow a seasonal ARMA,

    (1 - phi(B)) (1 - Phi(B^m)) u_t = (1 + theta(B)) (1 + Theta(B^m)) e_t.

The Gaussian likelihood is exact: a Kalman filter over the errors' state
space, started from the stationary covariance; a gap in the calendar is a
step without an observation.  The innovation variance and the regression are
profiled out by filtering the regressors alongside the series.  The filter
runs over a whole batch of parameter vectors, so a gradient or a line search
is one pass over the series.  Coefficients are searched as partial
autocorrelations (stationary and invertible everywhere), from a start by
Hannan and Rissanen, with BFGS.

The order search fixes d by repeated KPSS tests and D by the strength of the
season, then walks through neighbouring orders as long as the AIC falls;
``stepwise=False`` tries every order.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tillcast.operators.forecast import STEPS, Z95, _key_schema, _series_frame, filled, next_dates, on_calendar
from tillcast.session import ship_package

KPSS_5 = 0.463             # fixed value: 5 % point of the level-stationarity statistic
SEASON_STRENGTH = 0.64     # of the season from which it is differenced
ROUNDS = 75                # of BFGS
EDGE = 0.9999              # largest partial autocorrelation


@dataclass(frozen=True, order=True)
class Order:
    p: int = 1
    d: int = 0
    q: int = 0
    P: int = 0
    D: int = 0
    Q: int = 0
    m: int = 1
    trend: str = "c"       # n: none, c: constant, t: a line without a constant, ct: both

    def sizes(self) -> tuple[int, int, int, int]:
        return self.p, self.q, self.P if self.m > 1 else 0, self.Q if self.m > 1 else 0


def differenced(y: np.ndarray, order: Order) -> np.ndarray:
    z = np.asarray(y, float)
    for _ in range(order.d):
        z = z[1:] - z[:-1]
    for _ in range(order.D if order.m > 1 else 0):
        z = z[order.m:] - z[:-order.m]
    return z


def regressors(n: int, trend: str) -> np.ndarray:
    cols = ([np.ones(n)] if "c" in trend else []) + ([np.arange(1.0, n + 1)] if "t" in trend else [])
    return np.column_stack(cols) if cols else np.zeros((n, 0))


# ------------------------------------------------------- coefficients
def from_partial(x: np.ndarray) -> np.ndarray:
    """Batch of unbounded numbers (rows) to stationary AR coefficients, by the
    Durbin-Levinson recursion on their partial autocorrelations."""
    r = EDGE * np.tanh(x)
    a = np.zeros_like(r)
    for k in range(r.shape[1]):
        before = a[:, :k].copy()
        a[:, k] = r[:, k]
        a[:, :k] = before - r[:, k:k + 1] * before[:, ::-1]
    return a


def to_partial(a: np.ndarray) -> np.ndarray:
    """The numbers that give these coefficients; coefficients outside the
    stationary region are drawn into it."""
    a, out = np.array(a, float), np.zeros(len(a))
    for k in range(len(a) - 1, -1, -1):
        r = float(np.clip(a[k], -0.95, 0.95))
        out[k] = np.arctanh(r / EDGE)
        a = (a[:k] + r * a[:k][::-1]) / (1 - r * r)
    return out


def polynomials(x: np.ndarray, order: Order) -> tuple[np.ndarray, np.ndarray]:
    """Expanded AR (minus the leading 1) and MA coefficients of each row."""
    p, q, P, Q = order.sizes()
    cut = np.cumsum([p, q, P, Q])
    phi, theta, Phi, Theta = from_partial(x[:, :cut[0]]), -from_partial(x[:, cut[0]:cut[1]]), from_partial(x[:, cut[1]:cut[2]]), -from_partial(x[:, cut[2]:])
    return -product(-phi, -Phi, order.m), product(theta, Theta, order.m)


def product(a: np.ndarray, s: np.ndarray, m: int) -> np.ndarray:
    """(1 + a(B)) (1 + s(B^m)) - 1 of each row."""
    out = np.zeros((len(a), a.shape[1] + m * s.shape[1]))
    out[:, :a.shape[1]] += a
    for j in range(s.shape[1]):
        at = m * (j + 1)
        out[:, at - 1] += s[:, j]
        out[:, at:at + a.shape[1]] += s[:, j:j + 1] * a
    return out


# ------------------------------------------------------------- filter
def stationary(T: np.ndarray, V: np.ndarray) -> np.ndarray:
    """P = T P T' + V by doubling, for a batch."""
    P, A = V, T
    for _ in range(40):
        step = A @ P @ A.transpose(0, 2, 1)
        P = P + step
        if np.abs(step).max() <= 1e-13 * max(np.abs(P).max(), 1e-300):
            break
        A = A @ A
    return P


@dataclass
class Filtered:
    loss: np.ndarray       # -2 log likelihood of each parameter vector
    sigma2: np.ndarray
    beta: np.ndarray
    n: int
    state: np.ndarray      # predicted state after the last step, series and regressors


def filtered(z: np.ndarray, X: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> Filtered:
    """Kalman filter of a batch of ARMA models over the series and, with the
    same gains, over its regressors."""
    B, r = len(ar), max(ar.shape[1], ma.shape[1] + 1)
    phi, R = np.zeros((B, r)), np.zeros((B, r))
    phi[:, :ar.shape[1]] = ar
    R[:, 0], R[:, 1:1 + ma.shape[1]] = 1.0, ma
    T = np.zeros((B, r, r))
    T[:, :, 0] = phi
    T[:, np.arange(r - 1), np.arange(1, r)] = 1.0
    V = R[:, :, None] * R[:, None, :]
    P = stationary(T, V)
    Y = np.column_stack([z, X])
    seen = ~np.isnan(Y).any(axis=1)
    x = np.zeros((B, r, Y.shape[1]))
    logs, cross = np.zeros(B), np.zeros((B, Y.shape[1], Y.shape[1]))
    steady = False
    for t in range(len(Y)):
        if not steady:
            F = np.maximum(P[:, 0, 0], 1e-300)
            gain = P[:, :, 0] / F[:, None]
        if seen[t]:
            v = Y[t] - x[:, 0, :]
            logs += np.log(F)
            cross += v[:, :, None] * v[:, None, :] / F[:, None, None]
            x = x + gain[:, :, None] * v[:, None, :]
            after = P if steady else P - gain[:, :, None] * P[:, None, 0, :]
        else:
            if steady:
                steady = False
            after = P
        x0 = phi[:, :, None] * x[:, None, 0, :]
        x0[:, :-1] += x[:, 1:]
        x = x0
        if steady:
            continue
        rows = phi[:, :, None] * after[:, None, 0, :]
        rows[:, :-1] += after[:, 1:]
        new = rows[:, :, None, 0] * phi[:, None, :]
        new[:, :, :-1] += rows[:, :, 1:]
        new += V
        # the covariance has settled: the gains stay until the next gap
        steady = bool(seen[t]) and float(np.abs(new - P).max()) <= 1e-11 * float(np.abs(P).max())
        P = new
    n, k = int(seen.sum()), X.shape[1]
    beta = np.zeros((B, k))
    rss = cross[:, 0, 0]
    if k:
        beta = np.linalg.solve(cross[:, 1:, 1:] + 1e-12 * np.eye(k) * np.trace(cross[:, 1:, 1:], axis1=1, axis2=2)[:, None, None], cross[:, 1:, :1])[:, :, 0]
        rss = rss - (beta * cross[:, 1:, 0]).sum(axis=1)
    sigma2 = np.maximum(rss / max(n, 1), 1e-300)
    loss = n * (math.log(2 * math.pi) + 1) + n * np.log(sigma2) + logs
    return Filtered(np.where(np.isfinite(loss), loss, 1e300), sigma2, beta, n, x)


def hannan_rissanen(u: np.ndarray, order: Order) -> np.ndarray:
    """Start: innovations of a long autoregression as regressors."""
    p, q, P, Q = order.sizes()
    m = order.m
    ar = [*range(1, p + 1), *(m * j for j in range(1, P + 1))]
    ma = [*range(1, q + 1), *(m * j for j in range(1, Q + 1))]
    u = filled(u)
    far = max([0, *ar, *ma])
    long = min(max(far, int(10 * math.log10(max(len(u), 2)))), len(u) // 3)
    if len(u) - long - far < 2 * len(ar + ma) + 4:
        return np.zeros(p + q + P + Q)
    lagged = lambda v, lags, start: np.column_stack([v[start - i:len(v) - i] for i in lags]) if lags else np.zeros((len(v) - start, 0))
    e = np.zeros_like(u)
    if ma and long:
        X = lagged(u, list(range(1, long + 1)), long)
        e[long:] = u[long:] - X @ np.linalg.lstsq(X, u[long:], rcond=None)[0]
    start = long + far
    X = np.hstack([lagged(u, ar, start), lagged(e, ma, start)])
    b = np.linalg.lstsq(X, u[start:], rcond=None)[0]
    cut = np.cumsum([p, P, q, Q])
    return np.concatenate([to_partial(b[:cut[0]]), to_partial(-b[cut[1]:cut[2]]), to_partial(b[cut[0]:cut[1]]), to_partial(-b[cut[2]:])])


def least(f, x: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """BFGS with gradients and line searches in batches: ``f`` takes rows."""
    k = len(x)
    if not k:
        return x
    h, lengths = 1e-5, 2.0 ** -np.arange(0, 14)

    def slope(x):
        out = f(np.concatenate([x[None, :], x + h * np.eye(k), x - h * np.eye(k)]))
        return out[0], (out[1:1 + k] - out[1 + k:]) / (2 * h)

    now, g = slope(x)
    H = np.eye(k) / max(1.0, float(np.abs(g).max()))
    for _ in range(rounds):
        way = -H @ g
        if way @ g >= 0:
            H, way = np.eye(k) / max(1.0, float(np.abs(g).max())), -g / max(1.0, float(np.abs(g).max()))
        way *= min(1.0, 3.0 / max(float(np.abs(way).max()), 1e-300))
        tried = f(x + lengths[:, None] * way)
        at = int(np.argmin(tried))
        if not tried[at] < now:
            break
        x2 = x + lengths[at] * way
        before = now
        now, g2 = slope(x2)
        s, y = x2 - x, g2 - g
        x, g = x2, g2
        if s @ y > 1e-12:
            rho = 1.0 / (s @ y)
            left = np.eye(k) - rho * np.outer(s, y)
            H = left @ H @ left.T + rho * np.outer(s, s)
        if before - now < 1e-8 * (1 + abs(now)):
            break
    return x


@dataclass
class Fit:
    order: Order
    x: np.ndarray
    ar: np.ndarray
    ma: np.ndarray
    beta: np.ndarray
    sigma2: float
    loglik: float
    aic: float
    n: int


def fit_sarima(y: np.ndarray, order: Order) -> Fit | None:
    """Maximum likelihood; None if the series is too short or constant."""
    z = differenced(y, order)
    known = z[~np.isnan(z)]
    X = regressors(len(z), order.trend)
    k = sum(order.sizes()) + X.shape[1]
    if len(known) <= k + 1 or float(np.ptp(known)) == 0.0:
        return None
    scale = float(known.std()) or 1.0
    z = z / scale
    seen = ~np.isnan(z)
    flat = z - (X @ np.linalg.lstsq(X[seen], z[seen], rcond=None)[0] if X.shape[1] else 0.0)
    loss = lambda xs: filtered(z, X, *polynomials(xs, order)).loss
    starts = np.stack([hannan_rissanen(flat, order), np.zeros(sum(order.sizes()))])
    x = least(loss, starts[int(np.argmin(loss(starts)))])
    ar, ma = polynomials(x[None, :], order)
    out = filtered(z, X, ar, ma)
    loglik = -0.5 * float(out.loss[0]) - out.n * math.log(scale)
    return Fit(order, x, ar[0], ma[0], out.beta[0] * scale, float(out.sigma2[0]) * scale ** 2, loglik, -2 * loglik + 2 * (k + 1), out.n)


def forecast(fit: Fit, y: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard error of the next h steps on the series' own scale."""
    order = fit.order
    z = differenced(y, order)
    X = regressors(len(z) + h, order.trend)
    mean = X @ fit.beta if X.shape[1] else np.zeros(len(X))
    state = filtered(z - mean[:len(z)], np.zeros((len(z), 0)), fit.ar[None, :], fit.ma[None, :]).state[0, :, 0]
    ahead = mean[len(z):].copy()
    for t in range(h):
        ahead[t] += state[0]
        first = state[0]
        state = np.r_[state[1:], 0.0]
        state[:len(fit.ar)] += fit.ar * first
    # the differences undone: y_t = z_t - sum of the differencing polynomial
    whole = np.ones(1)
    for _ in range(order.d):
        whole = np.convolve(whole, [1.0, -1.0])
    for _ in range(order.D if order.m > 1 else 0):
        whole = np.convolve(whole, np.r_[1.0, np.zeros(order.m - 1), -1.0])
    past = list(filled(np.asarray(y, float))[-(len(whole) - 1):]) if len(whole) > 1 else []
    level = []
    for v in ahead:
        value = v - sum(c * past[-i] for i, c in enumerate(whole[1:], 1))
        past.append(value)
        level.append(value)
    full = -np.convolve(whole, np.r_[1.0, -fit.ar])[1:]
    psi = np.zeros(h)
    psi[0] = 1.0
    for t in range(1, h):
        psi[t] = (fit.ma[t - 1] if t <= len(fit.ma) else 0.0) + sum(full[i - 1] * psi[t - i] for i in range(1, min(t, len(full)) + 1))
    return np.array(level), np.sqrt(fit.sigma2 * np.cumsum(psi ** 2))


# ------------------------------------------------------- order search
def kpss(y: np.ndarray) -> float:
    """Statistic of level stationarity with Bartlett weights."""
    y = y[~np.isnan(y)]
    n = len(y)
    if n < 3 or float(np.ptp(y)) == 0.0:
        return 0.0
    e = y - y.mean()
    lags = int(4 * (n / 100) ** 0.25)
    var = float(e @ e) / n + 2 * sum((1 - j / (lags + 1)) * float(e[j:] @ e[:-j]) / n for j in range(1, lags + 1))
    return float((np.cumsum(e) ** 2).sum()) / (n * n * var) if var > 0 else 0.0


def season_strength(y: np.ndarray, m: int) -> float:
    """1 - var(rest) / var(rest + season), after a centred moving average."""
    y = filled(y)
    if len(y) < 2 * m:
        return 0.0
    weights = np.r_[0.5, np.ones(m - 1), 0.5] / m if m % 2 == 0 else np.ones(m) / m
    half = len(weights) // 2
    flat = y[half:len(y) - half] - np.convolve(y, weights, "valid")
    phase = (np.arange(len(flat)) + half) % m
    season = np.array([flat[phase == k].mean() if (phase == k).any() else 0.0 for k in range(m)])[phase]
    both = float(flat.var())
    return max(0.0, 1 - float((flat - season).var()) / both) if both > 0 else 0.0


def choose_differences(y: np.ndarray, m: int, max_d: int, max_D: int) -> tuple[int, int]:
    D = int(max_D > 0 and m > 1 and season_strength(y, m) >= SEASON_STRENGTH)
    z, d = differenced(y, Order(D=D, m=m)), 0
    while d < max_d and kpss(z) > KPSS_5:
        z, d = np.diff(z), d + 1
    return d, D


def search_order(y: np.ndarray, max_p: int = 3, max_q: int = 3, max_P: int = 0, max_Q: int = 0, m: int = 1,
                 max_d: int = 2, max_D: int = 1, trend: str | None = None, stepwise: bool = True) -> tuple[Fit, int] | None:
    """The fit of the lowest AIC (ties: the smaller order) and the number of
    orders tried.  ``trend``: fixed; None tries with and without a constant
    where the series is differenced once at most."""
    if m <= 1:
        max_P = max_Q = 0
    d, D = choose_differences(y, m, max_d, max_D)
    trends = [trend] if trend is not None else ["c", "n"] if d + D <= 1 else ["n"]
    tried: dict[Order, Fit | None] = {}

    def score(order: Order) -> tuple:
        if order not in tried:
            tried[order] = fit_sarima(y, order)
        fit = tried[order]
        return (fit.aic if fit is not None and math.isfinite(fit.aic) else math.inf, order)

    def make(p, q, P, Q, t):
        return Order(p, d, q, P, D, Q, m, t)

    if not stepwise:
        best = min(score(make(p, q, P, Q, t)) for p in range(max_p + 1) for q in range(max_q + 1)
                   for P in range(max_P + 1) for Q in range(max_Q + 1) for t in trends)
    else:
        s = int(max_P > 0), int(max_Q > 0)
        begin = {make(min(2, max_p), min(2, max_q), *s, trends[0]), make(0, 0, 0, 0, trends[0]),
                 make(min(1, max_p), 0, s[0], 0, trends[0]), make(0, min(1, max_q), 0, s[1], trends[0]), make(0, 0, 0, 0, trends[-1])}
        best = min(map(score, begin))
        while True:
            o = best[1]
            moves = set()
            for dp, dq in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (-1, -1), (1, -1), (-1, 1)):
                moves.add((o.p + dp, o.q + dq, o.P, o.Q, o.trend))
                moves.add((o.p, o.q, o.P + dp, o.Q + dq, o.trend))
            moves |= {(o.p, o.q, o.P, o.Q, t) for t in trends}
            near = [make(p, q, P, Q, t) for p, q, P, Q, t in moves if 0 <= p <= max_p and 0 <= q <= max_q and 0 <= P <= max_P and 0 <= Q <= max_Q]
            found = min([best, *map(score, near)])
            if not found[0] < best[0]:
                break
            best = found
    return (tried[best[1]], len(tried)) if best[0] < math.inf else None


# ------------------------------------------------------------ operators
ORDER_COLUMNS = ["p", "d", "q", "sp", "sd", "sq", "trend"]
ORDER_SCHEMA = "p int, d int, q int, sp int, sd int, sq int, trend string"


def _order_values(order: Order) -> dict:
    return dict(zip(ORDER_COLUMNS, (order.p, order.d, order.q, order.P, order.D, order.Q, order.trend), strict=True))


def _per_series(df: DataFrame, y: str, ds: str, keys: Sequence[str], columns: str, names: list[str], step: str, log: bool, make) -> DataFrame:
    """``make(series on its calendar)`` gives rows for each series, or None."""
    if step not in STEPS:
        raise ValueError(f"step is one of {sorted(STEPS)}")
    ship_package(df.sparkSession)
    src, gk = _series_frame(df, keys, ds, y)
    out = [*gk, *names]

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = make(on_calendar(pdf, ds, step, log))
        if rows is None:
            return pd.DataFrame(columns=out)
        for k in gk:
            rows[k] = pdf[k].iloc[0]
        return rows[out]

    return src.groupBy(*gk).applyInPandas(fn, _key_schema(src, gk) + ", " + columns)


def sarima_coefficients(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey", keys: Sequence[str] = (),
                        order: Order = Order(), log: bool = False, step: str = "day") -> DataFrame:
    """Expanded AR and MA coefficients by lag, the regression and the variance of
    each series: name (ar, ma, beta, sigma2), lag, value, loglik, aic, n.  A
    series that is too short or constant has no rows."""
    def make(s: pd.Series):
        fit = fit_sarima(s.to_numpy(), order)
        if fit is None:
            return None
        rows = [("ar", i, v) for i, v in enumerate(fit.ar, 1)] + [("ma", i, v) for i, v in enumerate(fit.ma, 1)]
        rows += [("beta", i, v) for i, v in enumerate(fit.beta)] + [("sigma2", 0, fit.sigma2)]
        return pd.DataFrame([(n, lag, float(v), fit.loglik, fit.aic, fit.n) for n, lag, v in rows], columns=["name", "lag", "value", "loglik", "aic", "n"])

    return _per_series(df, y, ds, keys, "name string, lag int, value double, loglik double, aic double, n int",
                       ["name", "lag", "value", "loglik", "aic", "n"], step, log, make)


def sarima_forecast(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey", keys: Sequence[str] = (),
                    order: Order | None = Order(), horizon: int = 30, log: bool = False, step: str = "day", **search) -> DataFrame:
    """Forecast of the ``horizon`` calendar steps after each series' last date:
    step, yhat, lo, hi (95 %; back from the logarithm when ``log``), aic and
    the order.  ``order=None`` searches it (``search``: arguments of
    ``search_order``).  A series that can't be fitted has no rows."""
    def make(s: pd.Series):
        vals = s.to_numpy()
        found = search_order(vals, **search) if order is None else None
        fit = found[0] if found else fit_sarima(vals, order) if order is not None else None
        if fit is None:
            return None
        mean, se = forecast(fit, vals, horizon)
        lo, hi = mean - Z95 * se, mean + Z95 * se
        if log:
            mean, lo, hi = np.exp(mean), np.exp(lo), np.exp(hi)
        return pd.DataFrame({ds: next_dates(s.index[-1], step, horizon), "step": np.arange(1, horizon + 1, dtype="int32"),
                             "yhat": mean, "lo": lo, "hi": hi, "aic": fit.aic, **_order_values(fit.order)})

    return _per_series(df, y, ds, keys, f"{ds} date, step int, yhat double, lo double, hi double, aic double, " + ORDER_SCHEMA,
                       [ds, "step", "yhat", "lo", "hi", "aic", *ORDER_COLUMNS], step, log, make)


def sarima_backtest(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey", keys: Sequence[str] = (),
                    order: Order = Order(), train_frac: float = 0.7, log: bool = False, step: str = "day") -> DataFrame:
    """Fit on the first part of each series (half-to-even rounding), forecast the
    rest: n_train, n_test, mae, rmse and the share of points inside the 95 %
    interval, on the series' own scale."""
    def make(s: pd.Series):
        vals = s.to_numpy()
        cut = round(len(vals) * train_frac)
        fit = fit_sarima(vals[:cut], order) if cut < len(vals) else None
        if fit is None:
            return None
        mean, se = forecast(fit, vals[:cut], len(vals) - cut)
        test, lo, hi = vals[cut:], mean - Z95 * se, mean + Z95 * se
        if log:
            mean, test, lo, hi = np.exp(mean), np.exp(test), np.exp(lo), np.exp(hi)
        known = ~np.isnan(test)
        e = (test - mean)[known]
        inside = ((test >= lo) & (test <= hi))[known]
        return pd.DataFrame([{"n_train": cut, "n_test": int(known.sum()), "mae": float(np.abs(e).mean()) if len(e) else None,
                              "rmse": float(np.sqrt((e ** 2).mean())) if len(e) else None, "covered": float(inside.mean()) if len(e) else None}])

    return _per_series(df, y, ds, keys, "n_train int, n_test int, mae double, rmse double, covered double",
                       ["n_train", "n_test", "mae", "rmse", "covered"], step, log, make)


def sarima_search(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey", keys: Sequence[str] = (),
                  log: bool = False, step: str = "day", **search) -> DataFrame:
    """The order of the lowest AIC of each series, its aic, loglik and the number
    of orders tried."""
    def make(s: pd.Series):
        found = search_order(s.to_numpy(), **search)
        if found is None:
            return None
        fit, tried = found
        return pd.DataFrame([{**_order_values(fit.order), "aic": fit.aic, "loglik": fit.loglik, "n": fit.n, "tried": tried}])

    return _per_series(df, y, ds, keys, ORDER_SCHEMA + ", aic double, loglik double, n int, tried int",
                       [*ORDER_COLUMNS, "aic", "loglik", "n", "tried"], step, log, make)

