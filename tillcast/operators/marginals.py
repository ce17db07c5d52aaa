"""Parametric marginals: truncated normal, gamma and beta.

All are fitted by maximum likelihood from two aggregates over the rows,
whatever their number: the ranges, then the means of each column's
sufficient statistics.  The truncated normal on a known range matches mean
and variance, the gamma solves for its shape by Newton from the means of x
and ln x, the beta from the means of ln x and ln (1 - x).  A column without
a named family takes the one whose distribution function is nearest to the
column's percentiles (Kolmogorov-Smirnov distance over the grid).

``Marginal.cdf`` and ``Marginal.ppf`` work on numpy batches inside tasks;
the inverse is by bisection.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.operators.quantiles import quantiles
from tillcast.sources.sinks import stored

FAMILIES = ("truncnorm", "gamma", "beta")
PAD = 1e-6              # of the range, added at both ends
GRID = [i / 100 for i in range(101)]
EPS = 1e-12


# ------------------------------------------------------ special functions
def digamma(x: float) -> float:
    out = 0.0
    while x < 10:
        out -= 1 / x
        x += 1
    y = 1 / (x * x)
    return out + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def trigamma(x: float) -> float:
    out = 0.0
    while x < 10:
        out += 1 / (x * x)
        x += 1
    y = 1 / (x * x)
    return out + 1 / x + y / 2 + y / x * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y / 30)))


def gamma_cdf(a: float, x: np.ndarray) -> np.ndarray:
    """Regularised lower incomplete gamma: a series below a + 1, a continued
    fraction (Lentz) above."""
    x = np.maximum(np.asarray(x, float), 0.0)
    out = np.zeros_like(x)
    scale = lambda v: np.exp(a * np.log(v) - v - math.lgamma(a))
    low = (x > 0) & (x < a + 1)
    if low.any():
        v = x[low]
        term = np.full_like(v, 1 / a)
        total = term.copy()
        for n in range(1, 2000):
            term = term * v / (a + n)
            total += term
            if (term < total * 1e-15).all():
                break
        out[low] = total * scale(v)
    high = x >= a + 1
    if high.any():
        v = x[high]
        b = v + 1 - a
        c, d = np.full_like(v, 1e300), 1 / b
        h = d.copy()
        for n in range(1, 2000):
            an = -n * (n - a)
            b = b + 2
            d = an * d + b
            d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
            c = b + an / c
            c = np.where(np.abs(c) < 1e-300, 1e-300, c)
            h = h * d * c
            if (np.abs(d * c - 1) < 1e-14).all():
                break
        out[high] = 1 - h * scale(v)
    return np.clip(out, 0.0, 1.0)


def beta_cdf(a: float, b: float, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta by its continued fraction, from the end at
    which that converges fast."""
    x = np.clip(np.asarray(x, float), 0.0, 1.0)
    out = np.where(x >= 1, 1.0, 0.0)
    inner = (x > 0) & (x < 1)
    v = x[inner]
    left = v < (a + 1) / (a + b + 2)
    part = np.empty_like(v)
    for side, p, q, y in ((left, a, b, v[left]), (~left, b, a, 1 - v[~left])):
        if not side.any():
            continue
        front = np.exp(p * np.log(y) + q * np.log1p(-y) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)) / p
        c, d = np.ones_like(y), 1 - (p + q) * y / (p + 1)
        d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
        h = d.copy()
        for m in range(1, 1000):
            for num in (m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1))):
                d = 1 + num * d
                d = 1 / np.where(np.abs(d) < 1e-300, 1e-300, d)
                c = 1 + num / c
                c = np.where(np.abs(c) < 1e-300, 1e-300, c)
                h = h * d * c
            if (np.abs(d * c - 1) < 1e-14).all():
                break
        part[side] = front * h
    out[inner] = np.where(left, part, 1 - part)
    return np.clip(out, 0.0, 1.0)


def normal_mass(a: float, b: float) -> float:
    """Phi(b) - Phi(a) without cancellation in a tail."""
    r = math.sqrt(2)
    if a > 0:
        return 0.5 * (math.erfc(a / r) - math.erfc(b / r))
    if b < 0:
        return 0.5 * (math.erfc(-b / r) - math.erfc(-a / r))
    return 0.5 * (math.erf(b / r) - math.erf(a / r))


_ERF = np.frompyfunc(math.erf, 1, 1)


def normal_cdf(z: np.ndarray | float) -> np.ndarray:
    return 0.5 * (1 + np.asarray(_ERF(np.asarray(z, float) / math.sqrt(2)), float))


# ------------------------------------------------------------------ fits
def truncated_moments(mu: float, sigma: float, lo: float, hi: float) -> tuple[float, float]:
    a, b = (lo - mu) / sigma, (hi - mu) / sigma
    mass = max(normal_mass(a, b), 1e-300)
    pa, pb = (math.exp(-0.5 * v * v) / math.sqrt(2 * math.pi) for v in (a, b))
    shift = (pa - pb) / mass
    return mu + sigma * shift, sigma ** 2 * (1 + (a * pa - b * pb) / mass - shift ** 2)


def fit_truncnorm(mean: float, var: float, lo: float, hi: float) -> tuple[float, float]:
    """mu and sigma whose truncation to [lo, hi] has this mean and variance:
    Newton in (mu, ln sigma), halved until the miss gets smaller.  A flatter
    column than any truncated normal ends at a wide one."""
    width = hi - lo
    goal = np.array([(mean - lo) / width, math.sqrt(max(var, 1e-300)) / width])

    def miss(p):
        m, v = truncated_moments(p[0], math.exp(p[1]), 0.0, 1.0)
        return np.array([m, math.sqrt(max(v, 0.0))]) - goal

    p = np.array([goal[0], math.log(max(goal[1], 1e-9))])
    now = miss(p)
    for _ in range(200):
        if float(np.abs(now).max()) < 1e-12:
            break
        J = np.column_stack([(miss(p + h) - miss(p - h)) / 2e-6 for h in np.eye(2) * 1e-6])
        step = np.linalg.lstsq(J, -now, rcond=None)[0]
        step *= min(1.0, 1.0 / max(float(np.abs(step).max()), 1e-300))
        for half in range(30):
            q = np.clip(p + step * 0.5 ** half, [-50.0, -12.0], [51.0, 4.0])
            if float((miss(q) ** 2).sum()) < float((now ** 2).sum()):
                break
        else:
            break
        p, now = q, miss(q)
    return lo + width * float(p[0]), width * math.exp(float(p[1]))


def fit_gamma(mean: float, mean_log: float) -> tuple[float, float]:
    """Shape and scale: ln(a) - digamma(a) = ln(mean) - mean of ln."""
    s = max(math.log(mean) - mean_log, 1e-9)
    a = (3 - s + math.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    for _ in range(100):
        step = (math.log(a) - digamma(a) - s) / (1 / a - trigamma(a))
        new = a - step if a - step > 0 else a / 2
        if abs(new - a) <= 1e-12 * a:
            a = new
            break
        a = new
    return a, mean / a


def fit_beta(mean: float, var: float, log_x: float, log_y: float) -> tuple[float, float]:
    """Both shapes, from the moments, by Newton on the likelihood equations
    (in logarithms, so that they stay above zero)."""
    var = min(max(var, 1e-12), mean * (1 - mean) * 0.999)
    k = mean * (1 - mean) / var - 1
    p = np.log(np.clip([mean * k, (1 - mean) * k], 1e-4, 1e8))
    miss = lambda p: np.array([digamma(math.exp(p[0])) - digamma(float(np.exp(p).sum())) - log_x,
                               digamma(math.exp(p[1])) - digamma(float(np.exp(p).sum())) - log_y])
    now = miss(p)
    for _ in range(100):
        if float(np.abs(now).max()) < 1e-12:
            break
        both = trigamma(float(np.exp(p).sum()))
        a, b = np.exp(p)
        J = np.array([[(trigamma(a) - both) * a, -both * b], [-both * a, (trigamma(b) - both) * b]])
        step = np.linalg.lstsq(J, -now, rcond=None)[0]
        step *= min(1.0, 2.0 / max(float(np.abs(step).max()), 1e-300))
        for half in range(30):
            q = np.clip(p + step * 0.5 ** half, math.log(1e-5), math.log(1e9))
            if float((miss(q) ** 2).sum()) < float((now ** 2).sum()):
                break
        else:
            break
        p, now = q, miss(q)
    return math.exp(float(p[0])), math.exp(float(p[1]))


@dataclass(frozen=True)
class Marginal:
    """family with two parameters on [lo, hi] (gamma: from lo on); truncnorm: mu,
    sigma; gamma: shape, scale; beta: both shapes.  ``constant``: one value."""
    family: str
    lo: float
    hi: float
    a: float = 0.0
    b: float = 0.0

    def cdf(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        if self.family == "constant":
            return np.full(len(x), 0.5)
        if self.family == "gamma":
            return gamma_cdf(self.a, (x - self.lo) / self.b)
        if self.family == "beta":
            return beta_cdf(self.a, self.b, (x - self.lo) / (self.hi - self.lo))
        low, mass = (self.lo - self.a) / self.b, normal_mass((self.lo - self.a) / self.b, (self.hi - self.a) / self.b)
        z = (np.clip(x, self.lo, self.hi) - self.a) / self.b
        flip = low > 0                    # in the upper tail both ends are near 1
        part = normal_cdf(-low) - normal_cdf(-z) if flip else normal_cdf(z) - normal_cdf(low)
        return np.clip(part / max(mass, 1e-300), 0.0, 1.0)

    def ppf(self, u: np.ndarray) -> np.ndarray:
        u = np.clip(np.asarray(u, float), EPS, 1 - EPS)
        if self.family == "constant" or not len(u):
            return np.full(len(u), self.lo)
        low, high = np.full(len(u), self.lo), np.full(len(u), self.hi)
        if self.family == "gamma":
            high[:] = self.lo + self.b * (self.a + 1)
            while (short := self.cdf(high) < u).any():
                high[short] = self.lo + (high[short] - self.lo) * 2
        for _ in range(80):
            mid = (low + high) / 2
            up = self.cdf(mid) < u
            low, high = np.where(up, mid, low), np.where(up, high, mid)
        return (low + high) / 2

    def distance(self, grid: Sequence[float]) -> float:
        """Kolmogorov-Smirnov distance from percentiles (equal ones: a step)."""
        values, at = np.unique(np.asarray(grid, float), return_inverse=True)
        share = np.array(GRID)
        upper = np.array([share[at == i].max() for i in range(len(values))])
        lower = np.array([share[at == i].min() for i in range(len(values))])
        f = self.cdf(values)
        return float(np.maximum(upper - f, f - lower).max(initial=0.0))


def fit_marginals(df: DataFrame, cols: Sequence[str], families: dict[str, str] | None = None, default: str | None = None,
                  grids: dict[str, list[float] | None] | None = None,
                  ranges: dict[str, tuple[float, float]] | None = None) -> dict[str, tuple[Marginal, float]]:
    """The marginal of each column and its KS distance from the percentiles.
    ``families`` names a column's family, ``default`` that of the others (None:
    the nearest).  Nulls and nan are skipped; a column without values has no
    entry.  ``grids``: percentiles, if they are known; ``ranges``: a column's
    support, where it is known (values beyond it count as its ends), else it
    is what was observed."""
    cols, families, ranges = list(cols), families or {}, ranges or {}
    bad = [f for f in [*families.values(), default] if f is not None and f not in FAMILIES]
    if bad:
        raise ValueError(f"unknown families {bad}, there are {FAMILIES}")
    if not cols:
        return {}
    # written once: the passes below read the columns alone
    df = stored(df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(c) for c in cols]), "marginals")
    value = {c: F.col(c) for c in cols}
    ends = df.agg(*[e for i, c in enumerate(cols) for e in (F.min(value[c]).alias(f"lo{i}"), F.max(value[c]).alias(f"hi{i}"))]).first()
    span = {c: (ends[f"lo{i}"], ends[f"hi{i}"]) for i, c in enumerate(cols) if ends[f"lo{i}"] is not None}
    wide = [c for c, (lo, hi) in span.items() if hi > lo]
    exprs = []
    for i, c in enumerate(wide):
        lo, hi = padded(*ranges.get(c, span[c]))
        x = F.when(value[c].isNotNull(), F.greatest(F.lit(PAD / 2), F.least((value[c] - lo) / (hi - lo), F.lit(1 - PAD / 2))))
        exprs += [F.avg(x).alias(f"m{i}"), F.var_pop(x).alias(f"v{i}"), F.avg(F.ln(x)).alias(f"l{i}"), F.avg(F.log1p(-x)).alias(f"r{i}")]
    row = df.agg(*exprs).first() if exprs else None
    grids = grids if grids is not None else quantiles(df, cols, GRID)
    out = {}
    for c, (lo, hi) in span.items():
        if c not in wide:
            out[c] = (Marginal("constant", lo, hi), 0.0)
            continue
        i = wide.index(c)
        lo, hi = padded(*ranges.get(c, (lo, hi)))
        width, mean, var, log_x, log_y = hi - lo, *(float(row[f"{k}{i}"]) for k in "mvlr")
        made = []
        for family in [families.get(c, default)] if families.get(c, default) else FAMILIES:
            if family == "truncnorm":
                mu, sigma = fit_truncnorm(mean, var, 0.0, 1.0)
                a, b = lo + width * mu, width * sigma
            elif family == "gamma":
                shape, scale = fit_gamma(mean, log_x)
                a, b = shape, width * scale
            else:
                a, b = fit_beta(mean, var, log_x, log_y)
            m = Marginal(family, lo, hi, a, b)
            made.append((m.distance(grids[c]), m))
        far, best = min(made, key=lambda v: v[0])
        out[c] = (best, far)
    return out


def padded(lo: float, hi: float) -> tuple[float, float]:
    pad = PAD * (hi - lo)
    return lo - pad, hi + pad


def marginals_table(df: DataFrame, cols: Sequence[str], families: dict[str, str] | None = None, default: str | None = None) -> DataFrame:
    """column, family, lo, hi, a, b and the KS distance from the percentiles."""
    found = fit_marginals(df, cols, families, default)
    return df.sparkSession.createDataFrame([(c, m.family, m.lo, m.hi, m.a, m.b, far) for c, (m, far) in found.items()],
                                           "column string, family string, lo double, hi double, a double, b double, ks double")
