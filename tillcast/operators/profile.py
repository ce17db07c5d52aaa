"""Data profiling: summaries, counts, histograms, box numbers, correlation,
normality.  Every operator is one or two distributed aggregates."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.operators.quantiles import quantiles
from tillcast.operators.ranking import cumulative_positions
from tillcast.operators.seasonal import money_mean, money_sum
from tillcast.session import ship_package
from tillcast.sources.sinks import stored


def global_stats(df: DataFrame, col: str = "SalesAmount") -> DataFrame:
    """Total, standard deviation and mean; sums of money are exact."""
    return df.agg(money_sum(col).alias("total"), F.stddev_samp(col).alias("std"),
                  money_mean(col).alias("mean"))


def describe(df: DataFrame, cols: Sequence[str], method: str = "exact") -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max per column - exact
    quartiles (``df.summary`` quartiles are approximate).  One row per
    column."""
    spark = df.sparkSession
    df = stored(df.select(*cols), "described")     # read by the moments and the quartiles
    base = df.agg(*[e for c in cols for e in (
        F.count(c).alias(f"{c}__n"), F.avg(c).alias(f"{c}__mean"),
        F.stddev_samp(c).alias(f"{c}__std"), F.min(F.col(c).cast("double")).alias(f"{c}__min"),
        F.max(F.col(c).cast("double")).alias(f"{c}__max"))]).first()
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method=method)
    rows = []
    for c in cols:
        qs = q[c] or [None, None, None]
        rows.append((c, int(base[f"{c}__n"]), base[f"{c}__mean"], base[f"{c}__std"],
                     base[f"{c}__min"], qs[0], qs[1], qs[2], base[f"{c}__max"]))
    return spark.createDataFrame(
        rows, "column string, count long, mean double, std double, min double, "
              "q25 double, q50 double, q75 double, max double")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one row (column -> count), one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in df.columns)
    return wide.selectExpr(f"stack({len(df.columns)}, {stack}) AS (column, nulls)")


def shape_schema(df: DataFrame) -> DataFrame:
    """A row for each column: position, name, type, and the frame's numbers of
    rows and columns."""
    types = df.sparkSession.createDataFrame([(i, c, t) for i, (c, t) in enumerate(df.dtypes)],
                                            "position int, column string, dtype string")
    n = df.agg(F.count(F.lit(1)).alias("rows"))   # one row
    return types.crossJoin(F.broadcast(n)).withColumn("columns", F.lit(len(df.columns)))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), F.asc_nulls_last(col))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def count_distinct(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    fn = F.approx_count_distinct(col) if approx else F.countDistinct(col)
    return df.agg(fn.alias(f"n_{col}"))


def min_value(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias(f"min_{col}"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed.  Returns
    every bin (empty ones with count 0) with its edges."""
    rng = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    spark = df.sparkSession
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    idx = F.least(F.floor((F.col(col) - F.col("lo")) / F.nullif(width, F.lit(0.0))),
                  F.lit(bins - 1))
    idx = F.coalesce(idx, F.lit(0)).cast("int")
    counted = (df.where(F.col(col).isNotNull()).crossJoin(F.broadcast(rng))
               .groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(
        F.broadcast(rng))
    w = (F.col("hi") - F.col("lo")) / F.lit(bins)
    return (all_bins.join(counted, "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * w).alias("left"),
                    (F.col("lo") + (F.col("bin") + 1) * w).alias("right"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def box_stats(df: DataFrame, col: str = "SalesAmount", factor: float = 1.5,
              method: str = "exact") -> DataFrame:
    """Quartiles, whiskers (furthest points within 1.5 IQR) and the
    number of points beyond them."""
    spark = df.sparkSession
    q = quantiles(df, [col], [0.25, 0.5, 0.75], method=method)[col]
    if q is None:
        return spark.createDataFrame([], "q1 double, median double, q3 double, "
                                         "lower_whisker double, upper_whisker double, "
                                         "n_outliers long")
    q1, med, q3 = q
    lo, hi = q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)
    c = F.col(col).cast("double")
    inside = (c >= F.lit(lo)) & (c <= F.lit(hi))
    return df.agg(
        F.lit(q1).alias("q1"), F.lit(med).alias("median"), F.lit(q3).alias("q3"),
        F.min(F.when(inside, c)).alias("lower_whisker"),
        F.max(F.when(inside, c)).alias("upper_whisker"),
        F.count_if(c.isNotNull() & ~inside).cast("long").alias("n_outliers"))


def _moments(centre: np.ndarray):
    """Sums of a task's rows for all pairs of columns, as matrix products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(centre)
        total = np.zeros((6, size, size))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - centre
            there = (~np.isnan(x)).astype(float)
            x = np.where(there > 0, x, 0.0)
            total += [there.T @ there, x.T @ there, there.T @ x, (x * x).T @ there, there.T @ (x * x), x.T @ x]
        i, j = np.triu_indices(size, 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *[pa.array(t[i, j]) for t in total]],
                                         names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])
    return run


def pearson(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, correlation) for all pairs of columns i < j by position, each over
    the rows that have both; null if one of the two is constant there.  One
    pass: a task adds its rows up, a pair's sums meet in one group."""
    num = [F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]
    flat = df.select(*num)
    ends = flat.agg(*[((F.min(c) + F.max(c)) / 2).alias(c) for c in flat.columns]).first()
    # moved to the middle of each column's range: a constant column is exactly 0
    centre = np.array([ends[c] if ends[c] is not None else 0.0 for c in flat.columns])
    names = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    sums = (flat.mapInArrow(_moments(centre), "i int, j int, " + ", ".join(f"{c} double" for c in names))
            .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in names]))
    var = lambda s, ss: F.greatest(F.lit(0.0), F.col("n") * F.col(ss) - F.col(s) * F.col(s))
    r = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.sqrt(var("sx", "sxx")) * F.sqrt(var("sy", "syy")))
    return sums.select("i", "j", F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("correlation"))


def named_pairs(df: DataFrame, cols: Sequence[str], a: str, b: str, out: str) -> DataFrame:
    """``pearson`` with the columns' names, a row for each pair."""
    ship_package(df.sparkSession)
    names = F.array(*[F.lit(c) for c in cols])
    return pearson(df, cols).select(names[F.col("i")].alias(a), names[F.col("j")].alias(b), F.col("correlation").alias(out))


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair; rows (var1, var2, correlation,
    absolute_correlation)."""
    long = named_pairs(df, cols, "var1", "var2", "correlation")
    return long.withColumn("absolute_correlation", F.abs("correlation"))


def top_correlated_pairs(df: DataFrame, cols: Sequence[str], k: int = 10) -> DataFrame:
    return (correlation_pairs(df, cols).where(F.col("correlation").isNotNull())
            .orderBy(F.desc("absolute_correlation"), "var1", "var2").limit(k))


# ---------------------------------------------------------------- normality
# Anderson-Darling critical values for the normal case
# (Stephens), significance levels 15, 10, 5, 2.5, 1 percent.
AD_SIGNIFICANCE = [15.0, 10.0, 5.0, 2.5, 1.0]
AD_BASE_CRITICAL = [0.576, 0.656, 0.787, 0.918, 1.092]

# Complementary error function, rational Chebyshev fit with fractional
# error below 1.2e-7 everywhere (so log tails stay accurate).
ERFC_COEFFS = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
               0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def erfc(x: Column) -> Column:
    z = F.abs(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * z)
    poly = F.lit(ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(F.lit(2.0) - ans)


def log_normal_cdf(z: Column) -> Column:
    """ln(Phi(z))."""
    return F.log(F.lit(0.5) * erfc(-z / F.lit(math.sqrt(2.0))))


def log_normal_sf(z: Column) -> Column:
    """ln(1 - Phi(z))."""
    return F.log(F.lit(0.5) * erfc(z / F.lit(math.sqrt(2.0))))


def anderson_darling(df: DataFrame, col: str = "SalesAmount") -> DataFrame:
    """A^2 statistic for normality (mean / sample std estimated) plus the
    critical values at the five significance levels.

    Each sorted value at rank i contributes (2i-1) ln F(z) +
    (2n-2i+1) ln(1-F(z)); ties share their rank span, so the sum runs over
    distinct values with their positions (two-level ranking)."""
    spark = df.sparkSession
    vals = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    stats = vals.agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mu"),
                     F.stddev_samp("v").alias("sd"))
    counts = vals.groupBy("v").agg(F.count(F.lit(1)).alias("w")).withColumn("k", F.lit(0))
    pos = cumulative_positions(counts)
    a, b = F.col("r0").cast("double"), F.col("r1").cast("double")
    n = F.col("n").cast("double")
    z = F.try_divide(F.col("v") - F.col("mu"), F.col("sd"))   # null for a constant column
    w = F.col("w").cast("double")
    sum_lo = b * b - (a - 1) * (a - 1)                       # sum of (2i-1) over a..b
    sum_hi = w * (2 * n + 1) - (b * (b + 1) - (a - 1) * a)   # sum of (2n-2i+1)
    contrib = sum_lo * log_normal_cdf(z) + sum_hi * log_normal_sf(z)
    total = pos.crossJoin(F.broadcast(stats)).agg(
        F.first("n").alias("n"), F.sum(contrib).alias("s"))
    out = total.select(
        F.col("n"),
        (-F.col("n") - F.col("s") / F.col("n")).alias("statistic"))
    crit = F.array(*[F.lit(c) / (F.lit(1.0) + F.lit(4.0) / F.col("n").cast("double")
                                 - F.lit(25.0) / (F.col("n").cast("double") ** 2))
                     for c in AD_BASE_CRITICAL])
    return out.select(
        "n", "statistic",
        F.arrays_zip(F.array(*[F.lit(s) for s in AD_SIGNIFICANCE]).alias("significance"),
                     crit.alias("critical")).alias("levels")
    ).select("n", "statistic", F.inline("levels")).select(
        "n", "statistic", "significance", "critical",
        (F.col("statistic") < F.col("critical")).alias("looks_normal"))
