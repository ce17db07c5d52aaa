"""Row filters and outlier rules.

Statistics (std-dev, quartiles) are computed in a one-row aggregate that
is cross-joined back as a broadcast (one row: a proven size bound), so
the filter stays a distributed ``where``.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast import schema as S
from tillcast.operators.quantiles import quantiles


def _with_stats(df: DataFrame, *stats: Column, stats_df: DataFrame | None = None) -> DataFrame:
    src = df if stats_df is None else stats_df
    return df.crossJoin(F.broadcast(src.agg(*stats)))


def clean_outliers(df: DataFrame, col: str = "SalesAmount", sigma: float = S.OUTLIER_SIGMA,
                   stats_df: DataFrame | None = None) -> DataFrame:
    """Keep rows with ``col <= sigma * stddev_samp(col)`` (not mean-centred;
    null values and a one-row input drop out, as NaN comparisons do).

    ``stats_df``: a narrower frame with the same multiset of ``col`` values
    (e.g. the fact before row-preserving dimension joins) to compute the
    threshold from."""
    out = _with_stats(df, (F.lit(sigma) * F.stddev_samp(col)).alias("__thr"), stats_df=stats_df)
    return out.where(F.col(col) <= F.col("__thr")).drop("__thr")


def outliers_zscore(df: DataFrame, col: str = "SalesAmount", limit: float = S.ZSCORE_LIMIT
                    ) -> DataFrame:
    """Flag ``|z| > limit`` with population std-dev (adds ``is_outlier``)."""
    out = _with_stats(df, F.avg(col).alias("__mu"), F.stddev_pop(col).alias("__sd"))
    z = (F.col(col) - F.col("__mu")) / F.nullif(F.col("__sd"), F.lit(0.0))
    return out.withColumn("is_outlier", F.coalesce(F.abs(z) > F.lit(limit), F.lit(False))) \
        .drop("__mu", "__sd")


def zscore_summary(df: DataFrame, col: str = "SalesAmount", limit: float = S.ZSCORE_LIMIT
                   ) -> DataFrame:
    flagged = outliers_zscore(df, col, limit)
    return flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col("is_outlier").cast("long")).alias("num_outliers"),
        (F.lit(100.0) * F.sum(F.col("is_outlier").cast("long")) / F.count(F.lit(1)))
        .alias("pct_outliers"))


def _quantile_bounds(df: DataFrame, col: str, lo_p: float, hi_p: float,
                     method: str) -> tuple[float | None, float | None]:
    q = quantiles(df, [col], [lo_p, hi_p], method=method)[col]
    return (None, None) if q is None else (q[0], q[1])


def outliers_iqr(df: DataFrame, col: str = "SalesAmount", factor: float = S.IQR_FACTOR,
                 method: str = "exact") -> DataFrame:
    """Rows outside ``[Q1 - f*IQR, Q3 + f*IQR]``."""
    q1, q3 = _quantile_bounds(df, col, 0.25, 0.75, method)
    if q1 is None:
        return df.limit(0)
    iqr = q3 - q1
    c = F.col(col)
    return df.where((c < F.lit(q1 - factor * iqr)) | (c > F.lit(q3 + factor * iqr)))


def outliers_quantile(df: DataFrame, col: str = "SalesAmount",
                      bounds: tuple[float, float] = S.QUANTILE_BOUNDS,
                      method: str = "exact") -> DataFrame:
    """Rows below the low or above the high quantile."""
    lo, hi = _quantile_bounds(df, col, bounds[0], bounds[1], method)
    if lo is None:
        return df.limit(0)
    c = F.col(col)
    return df.where((c < F.lit(lo)) | (c > F.lit(hi)))


def threshold_count(df: DataFrame, col: str = "SalesAmount", threshold: float = 300000.0
                    ) -> DataFrame:
    """Non-null count of every column among rows with ``col >= threshold``."""
    sub = df.where(F.col(col) >= F.lit(threshold))
    return sub.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])


def nonzero_filter(df: DataFrame, col: str = "ReturnAmount") -> DataFrame:
    return df.where(F.col(col) != 0)


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def key_value_filter(df: DataFrame, keys: Sequence[str] | None,
                     values: Sequence | None) -> DataFrame:
    """Equality filters from parallel key / value lists (keys validated
    against the schema)."""
    if not keys:
        return df
    if values is None or len(keys) != len(values):
        raise ValueError("keylist and valuelist must have the same length")
    unknown = [k for k in keys if k not in df.columns]
    if unknown:
        raise ValueError(f"unknown filter columns: {unknown}")
    conds = [F.col(k) == F.lit(v).cast(df.schema[k].dataType) for k, v in zip(keys, values)]
    return df.where(reduce(lambda a, b: a & b, conds))
