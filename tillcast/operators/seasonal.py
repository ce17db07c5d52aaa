"""Calendar-grain aggregation (daily, weekly, monthly, quarterly, yearly).

One ``groupBy().agg()`` per grain (partial + final hash aggregate, one
shuffle on the grain key), or all five grains rolled up from one state per
day.  Null rules follow the original pipeline: a sum over only nulls is
0, means skip nulls, "first" takes the value on the period's earliest
date, rows with a null group key are dropped.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tillcast import schema as S

ALL_GRAIN_KEYS = ["DateKey", "CalendarYear", "CalendarWeekLabel", "MonthNumber",
                  "CalendarQuarterLabel"]


MONEY = "decimal(18,4)"


def _sum0(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).alias(c)


def money_sum(c: str) -> Column:
    """Sum of a money column at 1/100 cent: each value rounded to
    DECIMAL(18,4), summed exactly, returned as double.  The result does
    not depend on partitioning or summation order."""
    return F.coalesce(F.sum(F.col(c).cast(MONEY)), F.lit(0)).cast("double").alias(c)


SCALED = "decimal(38,12)"


def exact_sum(c: str) -> Column:
    """Sum of scaled values at 12 decimals: the same in any order; 0 over nulls."""
    return F.coalesce(F.sum(F.col(c).cast(SCALED)), F.lit(0)).cast("double").alias(c)


def exact_mean(c: str) -> Column:
    """Mean whose sum does not depend on the summation order: values are
    rounded to 12 decimals, summed as DECIMAL, then divided once."""
    return (F.sum(F.col(c).cast(SCALED)).cast("double") / F.count(c)).alias(c)


def _first(c: str, order: str = "DateKey") -> Column:
    return F.min_by(F.col(c), F.col(order)).alias(c)


def _drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def onehot_like(df: DataFrame, prefixes: Sequence[str] = S.ONE_HOT_COLUMNS) -> list[str]:
    return [c for c in df.columns if any(c.startswith(p + "_") for p in prefixes)]


def feature_aggs(df: DataFrame, grain: str, onehot_cols: Sequence[str] | None = None,
                 include_total_cost: bool = True) -> list[Column]:
    """The aggregate list of the feature table for one grain."""
    cols = set(df.columns)
    onehot_cols = list(onehot_cols) if onehot_cols is not None else onehot_like(df)
    keys = set(S.GRAIN_KEYS[grain])
    aggs: list[Column] = []
    sums = [c for c in S.SUM_COLUMNS if c in cols]
    if include_total_cost and "TotalCost" in cols:
        sums.append("TotalCost")
    aggs += [_sum0(c) if c == "SalesQuantity" else exact_sum(c) for c in sums]
    if "SalesAmount" in cols:  # the raw target: an exact money sum
        aggs.append(money_sum("SalesAmount"))
    # means of few-level scaled values can land on exact decimal ties, so
    # they are summed order-independently (DECIMAL) before the division
    aggs += [exact_mean(c) for c in S.MEAN_COLUMNS if c in cols]
    aggs += [F.avg(c).alias(c) for c in onehot_cols if c in cols]   # sums of 0 and 1 are exact
    firsts = ([] if "CalendarYear" in keys else ["CalendarYear"]) + S.CYCLIC_FIRST[grain]
    aggs += [_first(c) for c in firsts if c in cols]
    return aggs


def seasonalize(df: DataFrame, grain: str = "daily", onehot_cols: Sequence[str] | None = None,
                include_total_cost: bool = True, extra: Sequence[str] = ()) -> DataFrame:
    """Aggregate the feature table to ``grain``, and by the ``extra`` columns."""
    keys = S.GRAIN_KEYS[grain]
    src = _drop_null_keys(df, keys)
    return src.groupBy(*keys, *extra).agg(*feature_aggs(df, grain, onehot_cols, include_total_cost))


def seasonalize_y(df: DataFrame, grain: str = "daily", target: str = "SalesAmount",
                  money: bool = True, ordered: bool = True) -> DataFrame:
    """Target only, per grain (ordered by the grain key unless the result
    feeds a join)."""
    keys = S.GRAIN_KEYS[grain]
    agg = money_sum(target) if money else _sum0(target)
    out = _drop_null_keys(df, keys).groupBy(*keys).agg(agg)
    return out.orderBy(*keys) if ordered else out


SIMPLE_AGGS, FULL_EXTRA_AGGS = S.SIMPLE_AGGS, S.FULL_EXTRA_AGGS


# Columns whose values are exact at 4 decimals: summed as DECIMAL, and
# averaged as exact sum / count (both independent of summation order).
MONEY_COLUMNS = {"UnitCost", "ReturnAmount", "DiscountAmount", "TotalCost", "SalesAmount",
                 "DiscountPercent", "SellingAreaSize", "UnitPrice"}
# Unit price (amount / quantity) has up to 7 decimals: averaged at 10.
PRICE_COLUMNS = {"UnitPrice"}
PRICE = "decimal(28,10)"


def money_mean(c: str) -> Column:
    """Mean of a money column: exact DECIMAL sum, then one division."""
    dec = PRICE if c in PRICE_COLUMNS else MONEY
    return (F.sum(F.col(c).cast(dec)).cast("double") / F.count(c)).alias(c)


def _agg_from_map(df: DataFrame, spec: dict[str, str], money: bool = True) -> list[Column]:
    """Aggregates from a {column: "sum"|"mean"} map; money columns are
    summed exactly at DECIMAL(18,4) when ``money`` (means stay double)."""
    out = []
    for c, how in spec.items():
        if c not in df.columns:
            continue
        val = F.col(c)
        if c == "IsWorkDay" and dict(df.dtypes)[c] == "string":
            val = F.when(val == "WorkDay", 1.0).when(val.isNotNull(), 0.0)
        if how == "mean":
            out.append(money_mean(c) if money and c in MONEY_COLUMNS else F.avg(val).alias(c))
        elif money and c in MONEY_COLUMNS and c not in PRICE_COLUMNS:
            out.append(money_sum(c))
        else:
            out.append(F.coalesce(F.sum(val), F.lit(0)).alias(c))
    return out


def seasonal_simple(df: DataFrame, grain: str = "daily", full: bool = False) -> DataFrame:
    """Raw-measure aggregation: mean unit cost/price, sums of the rest
    (``full`` adds discount %, workday share, weight, employees, area)."""
    spec = dict(SIMPLE_AGGS)
    if full:
        spec.update(FULL_EXTRA_AGGS)
    keys = S.GRAIN_KEYS[grain]
    return _drop_null_keys(df, keys).groupBy(*keys).agg(*_agg_from_map(df, spec))


def group_all_sum(df: DataFrame, key: str = "DateKey") -> DataFrame:
    """Sum of every numeric column by ``key``; fractions are summed exactly at
    10 decimals, so that the order of the rows doesn't matter."""
    num = [f for f in df.schema.fields if f.name != key and isinstance(f.dataType, NumericType)]
    sums = [F.coalesce(F.sum(F.col(f.name).cast(PRICE)), F.lit(0)).cast("double").alias(f.name)
            if f.dataType.typeName() in ("double", "float") else _sum0(f.name) for f in num]
    return _drop_null_keys(df, [key]).groupBy(key).agg(*sums)


def grain_of(gid: Column) -> Column:
    """Grain name from ``grouping_id()`` over ``ALL_GRAIN_KEYS``."""
    expr = None
    for grain, keys in S.GRAIN_KEYS.items():
        bits = sum(1 << (len(ALL_GRAIN_KEYS) - 1 - i)
                   for i, k in enumerate(ALL_GRAIN_KEYS) if k not in keys)
        expr = (F.when(gid == bits, F.lit(grain)) if expr is None
                else expr.when(gid == bits, F.lit(grain)))
    return expr


def _states(df: DataFrame, spec: dict[str, str]) -> list[tuple[dict[str, Column], Column]]:
    """For each aggregate of a {column: "sum"|"mean"} map: states of rows that
    add up over days, and the aggregate from their sums."""
    out = []
    for c, how in spec.items():
        if c not in df.columns:
            continue
        val, total, count = F.col(c), f"{c}__sum", f"{c}__count"
        money = c in MONEY_COLUMNS
        if c == "IsWorkDay" and dict(df.dtypes)[c] == "string":
            val = F.when(val == "WorkDay", 1.0).when(val.isNotNull(), 0.0)
        if how == "mean":
            exact = val.cast(PRICE if c in PRICE_COLUMNS else MONEY) if money else val.cast("double")
            out.append(({total: F.sum(exact), count: F.count(val)},
                        F.try_divide(F.sum(total).cast("double"), F.sum(count)).alias(c)))
        elif money and c not in PRICE_COLUMNS:
            out.append(({total: F.sum(val.cast(MONEY))}, F.coalesce(F.sum(total), F.lit(0)).cast("double").alias(c)))
        else:
            out.append(({total: F.sum(val)}, F.coalesce(F.sum(total), F.lit(0)).alias(c)))
    return out


def multi_grain(df: DataFrame, spec: dict[str, str] | None = None,
                grains: Sequence[str] = S.GRAINS) -> DataFrame:
    """All requested grains: a ``grain`` column plus the grain keys (null where
    not part of the grain).  The rows are aggregated once, to a state per
    day; the grains are rolled up from the days, whose number the calendar
    bounds."""
    states = _states(df, spec or SIMPLE_AGGS)
    src = df.where(F.col("DateKey").isNotNull() & F.col("CalendarYear").isNotNull())
    days = src.groupBy(*ALL_GRAIN_KEYS).agg(*[e.alias(n) for s, _ in states for n, e in s.items()])
    sets = [S.GRAIN_KEYS[g] for g in grains]
    out = days.groupingSets(sets, *ALL_GRAIN_KEYS).agg(*[last for _, last in states], F.grouping_id().alias("_gid"))
    return out.withColumn("grain", grain_of(F.col("_gid"))).drop("_gid")


def grouped_agg(df: DataFrame, group_cols: Sequence[str] = (), target: str = "SalesAmount",
                key: str = "DateKey") -> DataFrame:
    """Sum of the target by day and any user-given columns."""
    keys = [key, *group_cols]
    return _drop_null_keys(df, [key]).groupBy(*keys).agg(money_sum(target))
