"""Fitted marginals: special functions, recovered parameters, draws by KS."""

import math

import numpy as np
import pytest

from tillcast.operators import marginals as M
from tillcast.operators import synth as syn


def ks(sample, m):
    x = np.sort(sample)
    f, n = m.cdf(x), len(x)
    return max((np.arange(1, n + 1) / n - f).max(), (f - np.arange(n) / n).max())


def test_special_functions():
    assert abs(M.digamma(1) + 0.5772156649015329) < 1e-12 and abs(M.trigamma(1) - math.pi ** 2 / 6) < 1e-10
    x = np.linspace(0.01, 30, 200)
    assert np.allclose(M.gamma_cdf(1.0, x), 1 - np.exp(-x), atol=1e-12)
    assert np.allclose(M.gamma_cdf(3.0, x), 1 - np.exp(-x) * (1 + x + x * x / 2), atol=1e-12)
    assert np.allclose(M.gamma_cdf(0.5, x), [math.erf(math.sqrt(v)) for v in x], atol=1e-10)
    u = np.linspace(0, 1, 101)
    assert np.allclose(M.beta_cdf(1, 1, u), u, atol=1e-12) and np.allclose(M.beta_cdf(2, 3, u), 6 * u**2 - 8 * u**3 + 3 * u**4, atol=1e-12)
    assert np.allclose(M.beta_cdf(0.5, 0.5, u), 2 / math.pi * np.arcsin(np.sqrt(u)), atol=1e-10)


@pytest.mark.parametrize("m", [M.Marginal("truncnorm", 0, 10, 4, 2), M.Marginal("truncnorm", 0, 1, -2, 0.8), M.Marginal("gamma", 5, 100, 0.7, 3),
                               M.Marginal("gamma", 0, 100, 40, 2), M.Marginal("beta", -1, 4, 0.3, 0.6), M.Marginal("beta", 0, 1, 30, 200)])
def test_inverse(m):
    u = np.linspace(0.001, 0.999, 77)
    assert np.allclose(m.cdf(m.ppf(u)), u, atol=1e-8)


def frame(spark, n=6000):
    rng = np.random.default_rng(8)
    z = rng.normal(size=4 * n)
    cols = {"cut": (20 + 6 * z)[(20 + 6 * z > 15) & (20 + 6 * z < 40)][:n], "gam": 3 + rng.gamma(2.5, 4.0, n), "bet": 10 + 5 * rng.beta(2, 5, n)}
    rows = list(zip(*[c.tolist() for c in cols.values()], [7.0] * n, strict=True))
    return spark.createDataFrame([*rows, (None, float("nan"), None, None)], "cut double, gam double, bet double, one double").repartition(3), cols


def test_parameters_are_recovered(spark):
    df, cols = frame(spark)
    got = M.fit_marginals(df, ["cut", "gam", "bet", "one"], {"cut": "truncnorm", "gam": "gamma", "bet": "beta"},
                          ranges={"cut": (15, 40), "gam": (3, 100), "bet": (10, 15)})
    cut, gam, bet = (got[c][0] for c in ("cut", "gam", "bet"))
    assert abs(cut.a - 20) < 1.0 and abs(cut.b - 6) < 0.7 and 15 <= cut.lo + 0.1 and cut.hi <= 40.1
    assert abs(gam.a - 2.5) < 0.2 and abs(gam.b - 4) < 0.4
    assert abs(bet.a - 2) < 0.2 and abs(bet.b - 5) < 0.7
    assert got["one"][0].family == "constant"
    for c, m in (("cut", cut), ("gam", gam), ("bet", bet)):      # draws against the column, two-sample KS at 5 %
        draw = np.sort(m.ppf(np.random.default_rng(1).random(4000)))
        real = np.sort(cols[c])
        at = np.concatenate([draw, real])
        far = np.abs(np.searchsorted(draw, at, "right") / len(draw) - np.searchsorted(real, at, "right") / len(real)).max()
        assert far < 1.358 * math.sqrt((len(draw) + len(real)) / (len(draw) * len(real))), c


def test_family_is_chosen_by_distance(spark):
    df, cols = frame(spark)
    table = {r.column: r for r in M.marginals_table(df, ["cut", "gam", "bet", "one"]).collect()}
    assert table["gam"].family == "gamma" and table["one"].family == "constant"
    for c in cols:
        m = M.Marginal(table[c].family, table[c].lo, table[c].hi, table[c].a, table[c].b)
        assert table[c].ks < 0.03 and abs(ks(cols[c], m) - table[c].ks) < 0.02
    with pytest.raises(ValueError, match="unknown families"):
        M.fit_marginals(df, ["cut"], default="cauchy")
    assert M.fit_marginals(df.limit(0), ["cut"]) == {}


def test_copula_draws_follow_the_marginals(spark):
    df, cols = frame(spark, 2000)
    model = syn.fit_copula(df.select(*cols), list(cols), families={"gam": "gamma", "cut": "truncnorm"}, default_family="beta")
    assert {c: m.family for c, m in model.marginals.items()} == {"cut": "truncnorm", "gam": "gamma", "bet": "beta"}
    out = syn.sample_copula(spark, model, rows=2000).toPandas()
    for c in cols:
        m, x = model.marginals[c], np.sort(out[c].to_numpy())
        assert ks(x, m) < 1.358 / math.sqrt(2000) + 1e-3, c      # one-sample KS at 5 % (rounding aside)
    plain = syn.fit_copula(df.select(*cols), list(cols))
    assert plain.marginals == {}
