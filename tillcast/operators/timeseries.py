"""Time-series operators on (series keys, ds, y) frames.

Windows are partitioned by the series keys.  A single series is one
window partition, which is fine because these operators run on
calendar-aggregated tables (one row per day/week/...: bounded by the
calendar, not by the data).  Row-level global orders (``lag_rows``) use
the two-level rank instead of a single-partition window.

Per-series model fits (AR, ADF, PACF, order search) run in
``groupBy(keys).applyInPandas``: one task per series, numpy on a few
thousand points.
"""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import ship_package


def _w(keys: Sequence[str], ds: str) -> Window:
    return Window.partitionBy(*keys).orderBy(ds) if keys else Window.orderBy(ds)



# ------------------------------------------------------------ lag / diff
def lag_baseline(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey",
                 keys: Sequence[str] = ()) -> DataFrame:
    """Previous value as the forecast (first row of each series dropped)
    and its R^2, per series."""
    pred = df.withColumn("y_pred", F.lag(y, 1).over(_w(keys, ds))).where(
        F.col("y_pred").isNotNull())
    return r2_by(pred, y, "y_pred", keys)


def r2_by(df: DataFrame, y: str, yhat: str, keys: Sequence[str] = ()) -> DataFrame:
    """R^2 = 1 - SS_res / SS_tot per group (SS_tot around the group mean;
    null when SS_tot is 0), in one pass."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (F.lit(1.0) - F.try_divide(F.sum((F.col(y) - F.col(yhat)) ** 2),
                                   F.var_pop(y) * F.count(y))).alias("r2"))


def diff(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey", keys: Sequence[str] = (),
         out: str = "diff") -> DataFrame:
    return df.withColumn(out, F.col(y) - F.lag(y, 1).over(_w(keys, ds)))


def diff_backfill(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey",
                  keys: Sequence[str] = (), out: str = "diff") -> DataFrame:
    """First difference with the first (null) value filled by the next one."""
    w = _w(keys, ds)
    d = F.col(y) - F.lag(y, 1).over(w)
    d_next = F.lead(y, 1).over(w) - F.col(y)
    return df.withColumn(out, F.coalesce(d, d_next))


def chrono_split_series(df: DataFrame, ds: str = "DateKey", keys: Sequence[str] = (),
                        train_frac: float = 0.7, as_log: bool = False,
                        y: str = "SalesAmount") -> DataFrame:
    """Flag the first round(frac*n) points of each series as train
    (half-to-even rounding); ``as_log`` adds ln(y) (null for y <= 0)."""
    w = _w(keys, ds)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys)) if keys else \
        F.count(F.lit(1)).over(Window.partitionBy())
    out = df.withColumn("rn", F.row_number().over(w)).withColumn("_n", n)
    out = out.withColumn("is_train", F.col("rn") <= F.bround(F.col("_n") * F.lit(train_frac), 0))
    if as_log:
        out = out.withColumn("log_y", F.when(F.col(y) > 0, F.ln(y)))
    return out.drop("_n")


# ---------------------------------------------------------- decomposition
def decompose(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey",
              keys: Sequence[str] = (), period: int = 365, model: str = "additive",
              money: bool = False) -> DataFrame:
    """Classical decomposition: centred moving-average trend (null where
    the window is incomplete; half-weighted ends for even periods),
    seasonal = mean detrended value per phase, centred (to 0 or to 1),
    residual.  ``money``: window sums are exact DECIMAL(18,4) sums.  A
    division by zero (multiplicative, trend or seasonal 0) gives null."""
    w = _w(keys, ds)
    half = period // 2
    out = df.withColumn("rn", F.row_number().over(w))
    frame = w.rowsBetween(-half, half)
    cnt = F.count(F.col(y)).over(frame)
    val = F.col(y).cast("decimal(18,4)") if money else F.col(y)
    s = F.sum(val).over(frame)
    if period % 2 == 1:
        trend = F.when(cnt == period, s.cast("double") / F.lit(float(period)))
    else:
        ends = F.first(val).over(frame) + F.last(val).over(frame)
        trend = F.when(cnt == period + 1,
                       (s - ends / F.lit(2)).cast("double") / F.lit(float(period)))
    out = out.withColumn("trend", trend)
    mult = model.startswith("m")
    detr = F.try_divide(F.col(y), F.col("trend")) if mult else F.col(y) - F.col("trend")
    out = out.withColumn("_detr", detr).withColumn("phase", (F.col("rn") - 1) % period)
    per_phase = out.groupBy(*keys, "phase").agg(F.avg("_detr").alias("_pm"))
    centre = per_phase.groupBy(*keys).agg(F.avg("_pm").alias("_c"))
    # without keys both have a bounded number of rows: one, and the period
    per_phase = (per_phase.join(centre, list(keys)) if keys else per_phase.crossJoin(F.broadcast(centre)))
    per_phase = per_phase.select(*keys, "phase", (F.try_divide(F.col("_pm"), F.col("_c")) if mult
                                                  else F.col("_pm") - F.col("_c"))
                                 .alias("seasonal"))
    out = out.join(per_phase if keys else F.broadcast(per_phase), [*keys, "phase"], "left")
    resid = (F.try_divide(F.col(y), F.col("trend") * F.col("seasonal")) if mult
             else F.col(y) - F.col("trend") - F.col("seasonal"))
    return out.withColumn("resid", resid).drop("_detr")


def deseasonalize(decomposed: DataFrame, y: str = "SalesAmount", model: str = "multiplicative"
                  ) -> DataFrame:
    adj = F.try_divide(F.col(y), F.col("seasonal")) if model.startswith("m") else F.col(y) - F.col("seasonal")
    return decomposed.withColumn("deseasonalized", adj)


# ------------------------------------------------------- autocorrelation
def acf(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey", keys: Sequence[str] = (),
        nlags: int = 30) -> DataFrame:
    """acf(k) = sum_t (y_t - m)(y_{t+k} - m) / sum_t (y_t - m)^2, k = 0..nlags;
    null for a constant series.  The lagged values come from one window per
    series."""
    keys = list(keys)
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    e = (F.col(y).cast("double") - F.avg(F.col(y).cast("double")).over(whole)).alias("e")
    cen = df.select(*keys, ds, e)
    w = _w(keys, ds)
    led = cen.select(*keys, "e", *[F.lead("e", k).over(w).alias(f"e{k}") for k in range(nlags + 1)])
    sums = led.groupBy(*keys).agg(*[F.sum(F.col("e") * F.col(f"e{k}")).alias(f"s{k}") for k in range(nlags + 1)])
    lags = F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"s{k}"), F.col("s0")).alias("acf")) for k in range(nlags + 1)])
    # a series shorter than a lag has no pair there
    return sums.select(*keys, F.inline(F.filter(lags, lambda x: x["acf"].isNotNull() | F.coalesce(F.col("s0") == 0, F.lit(False)))))


def exp_restore(df: DataFrame, *cols: str) -> DataFrame:
    """Columns on the ln scale back on their own scale."""
    return df.withColumns({c: F.exp(c) for c in cols})


def _durbin_levinson(r: np.ndarray) -> np.ndarray:
    """PACF from autocorrelations r[0..K] (Yule-Walker, Durbin-Levinson)."""
    k_max = len(r) - 1
    out = np.zeros(k_max + 1)
    out[0] = 1.0
    if k_max == 0:
        return out
    phi = np.zeros(k_max + 1)
    prev = np.zeros(k_max + 1)
    v = 1.0
    for k in range(1, k_max + 1):
        acc = r[k] - np.dot(prev[1:k], r[1:k][::-1])
        a = acc / v if v != 0 else np.nan
        phi[1:k] = prev[1:k] - a * prev[1:k][::-1]
        phi[k] = a
        v = v * (1 - a * a)
        out[k] = a
        prev = phi.copy()
    return out


def pacf(df: DataFrame, y: str = "SalesAmount", ds: str = "DateKey", keys: Sequence[str] = (),
         nlags: int = 30) -> DataFrame:
    """Partial autocorrelation per series: the <= nlags+1 ACF values of a
    series are solved with Durbin-Levinson in one pandas call per series."""
    ship_package(df.sparkSession)
    a = acf(df, y, ds, keys, nlags)
    keys = list(keys)
    grp = keys if keys else []
    src = a if keys else a.withColumn("_series", F.lit(0))
    gk = grp if grp else ["_series"]
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields
                        if f.name in gk] + ["lag int", "pacf double"])

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        vals = _durbin_levinson(pdf["acf"].to_numpy(dtype=float))
        out = pd.DataFrame({"lag": pdf["lag"].to_numpy(dtype="int32"), "pacf": vals})
        for k in gk:
            out[k] = pdf[k].iloc[0]
        return out[gk + ["lag", "pacf"]]

    res = src.groupBy(*gk).applyInPandas(fn, schema)
    return res if keys else res.drop("_series")
