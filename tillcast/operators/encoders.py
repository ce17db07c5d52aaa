"""Fitted encoders: statistics learned on one frame, applied to any frame.

Fitted parameters are small values (medians/IQRs, category lists) or, for
label maps whose size grows with the data, a DataFrame that is joined
back with a size-checked broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tillcast.functions.scalars import sanitize_name
from tillcast.operators.joins import checked_broadcast
from tillcast.operators.quantiles import quantiles
from tillcast.operators.ranking import global_row_number
from tillcast.session import ensure_checkpoint_dir


# --------------------------------------------------------------------- robust
@dataclass
class RobustParams:
    center: dict[str, float | None]
    scale: dict[str, float | None]


def fit_robust(df: DataFrame, cols: Sequence[str], method: str = "exact", store: bool = False) -> RobustParams:
    """Median and inter-quartile range per column, all at once; an IQR of 0
    scales by 1.  ``store``: see ``quantiles``."""
    return robust_of(quantiles(df, cols, [0.25, 0.5, 0.75], method=method, store=store))


def robust_of(q: dict[str, list[float] | None]) -> RobustParams:
    """Parameters from the quartiles of each column."""
    center, scale = {}, {}
    for c in q:
        if q[c] is None:
            center[c], scale[c] = None, None
            continue
        q1, med, q3 = q[c]
        iqr = q3 - q1
        center[c] = med
        scale[c] = iqr if iqr != 0 else 1.0
    return RobustParams(center, scale)


def robust_expr(c: str | Column, center: float | None, scale: float | None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if center is None or scale is None:
        return F.lit(None).cast("double")
    return (col.cast("double") - F.lit(center)) / F.lit(scale)


def apply_robust(df: DataFrame, params: RobustParams, rename: dict[str, str] | None = None
                 ) -> DataFrame:
    rename = rename or {}
    return df.withColumns({rename.get(c, c): robust_expr(c, params.center[c], params.scale[c])
                           for c in params.center})


# -------------------------------------------------------------------- one-hot
@dataclass
class OneHotParams:
    categories: dict[str, list]  # sorted, null last
    handle_unknown: str = "error"
    drop_binary: bool = False

    def output_columns(self) -> list[str]:
        out = []
        for c, cats in self.categories.items():
            use = cats[1:] if self.drop_binary and len(cats) == 2 else cats
            out.extend(onehot_name(c, v) for v in use)
        return out


def onehot_name(col: str, value) -> str:
    return sanitize_name(f"{col}_{'None' if value is None else value}")


def ordered(values: Sequence[str | None], numeric: bool) -> list:
    """Categories in their own order: numbers by value, text by code point,
    null last."""
    return sorted(values, key=lambda v: (v is None, (float(v) if numeric else v) if v is not None else 0))


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(k, s, w): rows of each value (as text, null too) of each column."""
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("k"), F.col(c).cast("string").alias("s")) for i, c in enumerate(cols)
    ])).alias("p")).select("p.k", "p.s")
    return pairs.groupBy("k", "s").agg(F.count(F.lit(1)).alias("w"))


def is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, NumericType)


def fit_onehot(df: DataFrame, cols: Sequence[str], handle_unknown: str = "error",
               drop_binary: bool = False, max_categories: int | None = None) -> OneHotParams:
    """Distinct values of all columns, from one pass.

    The list has an entry for each column of the wide form, so it is as
    long as the encoded frame is wide; for columns with more categories
    than a frame should have columns use ``onehot_long``.  Numbers of
    categories are counted first if ``max_categories`` limits them."""
    return onehot_of(df, list(cols), category_counts(df, cols), handle_unknown, drop_binary, max_categories)


def onehot_of(df: DataFrame, cols: list[str], counts: DataFrame, handle_unknown: str = "error",
              drop_binary: bool = False, max_categories: int | None = None) -> OneHotParams:
    """Parameters from the value counts of each column (``category_counts``)."""
    if max_categories is not None:
        for r in counts.groupBy("k").count().collect():   # a row for each column
            if r["count"] > max_categories:
                raise ValueError(f"column {cols[r['k']]} has {r['count']} categories; use onehot_long")
    cats: dict[str, list] = {c: [] for c in cols}
    for r in counts.select("k", "s").collect():
        cats[cols[r["k"]]].append(r["s"])
    return OneHotParams({c: ordered(v, is_numeric(df, c)) for c, v in cats.items()}, handle_unknown, drop_binary)


def onehot_long(df: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The ones of a one-hot encoding as rows: key, column, category (null is a
    category).  For any number of categories; nothing is fitted."""
    return df.select(*key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in cols])).alias("p")
    ).select(*key, "p.column", "p.category")


def onehot_columns(params: OneHotParams, as_type: str = "double") -> dict[str, Column]:
    exprs: dict[str, Column] = {}
    for c, cats in params.categories.items():
        use = cats[1:] if params.drop_binary and len(cats) == 2 else cats
        s = F.col(c).cast("string")
        for v in use:
            hit = s.isNull() if v is None else (s == F.lit(v))
            exprs[onehot_name(c, v)] = F.when(hit, F.lit(1)).otherwise(F.lit(0)).cast(as_type)
    return exprs


def _known(c: str, cats: list) -> Column:
    s = F.col(c).cast("string")
    known = [v for v in cats if v is not None]
    ok = s.isin(known) if known else F.lit(False)
    if None in cats:
        ok = ok | s.isNull()
    return F.coalesce(ok, F.lit(False))


def apply_onehot(df: DataFrame, params: OneHotParams, drop_original: bool = True,
                 as_type: str = "double") -> DataFrame:
    """Wide 0/1 columns, all in one projection.  With ``handle_unknown =
    "error"`` an unseen category fails the job when the row is encoded
    (``raise_error`` inside the expression: no extra pass over the data)."""
    exprs = onehot_columns(params, as_type)
    if params.handle_unknown == "error":
        for c, cats in params.categories.items():
            use = cats[1:] if params.drop_binary and len(cats) == 2 else cats
            if not use:
                continue
            first = onehot_name(c, use[0])
            exprs[first] = F.when(~_known(c, cats), F.raise_error(
                F.concat(F.lit(f"unknown category in {c}: "),
                         F.coalesce(F.col(c).cast("string"), F.lit("null"))))
            ).otherwise(exprs[first]).cast(as_type)
    out = df.withColumns(exprs)
    return out.drop(*params.categories) if drop_original else out


# ---------------------------------------------------------------------- label
@dataclass
class LabelParams:
    maps: dict[str, DataFrame] = field(default_factory=dict)  # value -> code (materialized)
    sizes: dict[str, int] = field(default_factory=dict)       # number of codes


def fit_label(df: DataFrame, cols: Sequence[str]) -> LabelParams:
    """Sorted distinct values -> 0..n-1; a null value gets code n (sorted
    last).  One pass and one rank for all columns."""
    return label_of(df, list(cols), category_counts(df, cols))


def label_of(df: DataFrame, cols: list[str], counts: DataFrame) -> LabelParams:
    """Codes from the value counts of each column (``category_counts``): one
    two-level rank over (column, value), less the rank before the column."""
    ensure_checkpoint_dir(df.sparkSession)
    values = counts.select("k", "s").where(F.col("s").isNotNull())
    number = F.when(F.col("k").isin([i for i, c in enumerate(cols) if is_numeric(df, c)] or [-1]), F.col("s").try_cast("double"))
    ranked = global_row_number(values.withColumn("v", number), ["k", "v", "s"], out="_rn").checkpoint(eager=True)
    first = {r["k"]: (r["lo"], r["n"]) for r in ranked.groupBy("k").agg(F.min("_rn").alias("lo"), F.count("*").alias("n")).collect()}
    params = LabelParams()
    for i, c in enumerate(cols):
        low, n = first.get(i, (1, 0))
        params.maps[c] = ranked.where(F.col("k") == i).select(
            F.col("s").alias(f"{c}__value"), (F.col("_rn") - F.lit(low)).cast("int").alias(f"{c}__code"))
        params.sizes[c] = n
    return params


def apply_label(df: DataFrame, params: LabelParams) -> DataFrame:
    """Join each code table (broadcast when its known size is within the
    bound, else a shuffle join); unseen values get null, nulls get n."""
    out = df
    for c, codes in params.maps.items():
        n = params.sizes[c]
        right = checked_broadcast(codes, max_rows=n)
        joined = out.join(right, out[c].cast("string") == right[f"{c}__value"], "left")
        joined = joined.withColumn(
            c, F.when(F.col(c).isNull(), F.lit(n)).otherwise(F.col(f"{c}__code")).cast("int"))
        out = joined.drop(f"{c}__value", f"{c}__code")
    return out
