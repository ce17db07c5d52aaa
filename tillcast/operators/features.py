"""The row-level feature chain (clean, convert, encode) with fit/transform.

``prepare_rows`` is stateless per row.  ``fit_features`` learns the
scaler, one-hot and label statistics from one frame; ``transform_features``
applies them to any frame (no refit on new data).

The raw calendar keys (year, week label, month, quarter) are kept next to
the features so that every grain can be aggregated after encoding; the
scaled year is a separate column ``CalendarYear_scaled``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast import schema as S
from tillcast.functions import scalars as sc
from tillcast.functions.calendar import cyclic
from tillcast.operators import encoders as enc
from tillcast.session import ensure_checkpoint_dir
from tillcast.sources.sinks import stored

SCALED_YEAR = "CalendarYear_scaled"


def prepare_rows(df: DataFrame) -> DataFrame:
    """Impute, strip, fill, flag, swap, convert units, parse the quarter and
    add the six cyclic columns; drop what the chain drops (the calendar
    grain keys stay)."""
    df = sc.drop_columns(df, "Unnamed: 0", "int64_field_0", "CurrencyKey")
    df = sc.impute_const(df, S.IMPUTE_ZERO_COLUMNS, 0)
    df = sc.strip_strings(df)
    df = sc.fill_na_label(df, "BrandName", S.BRAND_FILL)
    quarter = sc.quarter_number(F.col("CalendarQuarterLabel"))
    sm, cm = cyclic("MonthNumber", S.MONTHS_IN_YEAR)
    sd, cd = cyclic("CalendarDayOfWeekNumber", S.DAYS_IN_WEEK)
    sq, cq = cyclic(quarter, S.QUARTERS_IN_YEAR)
    df = df.withColumns({
        "PromotionKey": sc.promo_flag(F.col("PromotionKey")),
        "StockTypeID": sc.stock_swap(F.col("StockTypeID")),
        "Weight_grams": sc.weight_to_grams(F.col("Weight"), F.col("WeightUnitMeasureID")),
        "sin_MonthNumber": sm, "cos_MonthNumber": cm,
        "sin_CalendarDayOfWeekNumber": sd, "cos_CalendarDayOfWeekNumber": cd,
        "sin_CalendarQuarterLabel": sq, "cos_CalendarQuarterLabel": cq,
        "CalendarQuarterLabel": quarter,
    })
    return df.drop("Weight", "WeightUnitMeasureID", "CalendarDayOfWeekNumber")


@dataclass
class FeatureModel:
    robust: enc.RobustParams
    onehot: enc.OneHotParams
    labels: enc.LabelParams

    @property
    def onehot_columns(self) -> list[str]:
        return self.onehot.output_columns()


FITTED = list(dict.fromkeys([*S.ROBUST_SCALE_COLUMNS, *S.ONE_HOT_COLUMNS, *S.LABEL_COLUMNS]))


def fit_features(df: DataFrame, handle_unknown: str = "error") -> FeatureModel:
    """Learn scaler / one-hot / label statistics from ``df``.  Its rows are
    prepared once and the columns that are fitted are written; the quartiles
    and the counts of each category read those."""
    ensure_checkpoint_dir(df.sparkSession)
    return fit_prepared(stored(prepare_rows(df).select(*FITTED), "prepared"), handle_unknown)


def fit_prepared(prepared: DataFrame, handle_unknown: str = "error") -> FeatureModel:
    """``fit_features`` of prepared rows that are cheap to read."""
    numeric, text = list(S.ROBUST_SCALE_COLUMNS), [*S.ONE_HOT_COLUMNS, *S.LABEL_COLUMNS]
    ensure_checkpoint_dir(prepared.sparkSession)
    robust = enc.fit_robust(prepared, numeric)
    counts = enc.category_counts(prepared, text).checkpoint(eager=True)

    def part(first: int, size: int) -> DataFrame:
        k = F.col("k") - F.lit(first)
        return counts.where((k >= 0) & (k < size)).select(k.alias("k"), "s", "w")

    onehot = enc.onehot_of(prepared, list(S.ONE_HOT_COLUMNS), part(0, len(S.ONE_HOT_COLUMNS)), handle_unknown)
    labels = enc.label_of(prepared, list(S.LABEL_COLUMNS), part(len(S.ONE_HOT_COLUMNS), len(S.LABEL_COLUMNS)))
    return FeatureModel(robust, onehot, labels)


def transform_features(df: DataFrame, model: FeatureModel) -> DataFrame:
    return transform_prepared(prepare_rows(df), model)


def transform_prepared(p: DataFrame, model: FeatureModel) -> DataFrame:
    p = enc.apply_robust(p, model.robust, rename={"CalendarYear": SCALED_YEAR})
    p = enc.apply_onehot(p, model.onehot, drop_original=True)
    p = enc.apply_label(p, model.labels)
    return sc.sanitize_columns(p)


def fit_transform(df: DataFrame, drop: Sequence[str] = ()) -> tuple[FeatureModel, DataFrame]:
    """The model of ``df`` and its rows transformed by it, without the ``drop``
    columns.  The rows are prepared and written once, and both read them:
    what ``df`` joins runs once."""
    ensure_checkpoint_dir(df.sparkSession)
    prepared = stored(prepare_rows(df).drop(*drop), "prepared")
    model = fit_prepared(prepared)
    return model, transform_prepared(prepared, model)


def preprocess_features(df: DataFrame, simple: bool = False) -> DataFrame:
    """Fit on ``df`` and transform it (the one-call form)."""
    if simple:
        return simple_preprocess(df)
    return fit_transform(df)[1]


def simple_preprocess(df: DataFrame, quantile_method: str = "exact") -> DataFrame:
    """Robust-scale every numeric column, pass the others through; each
    value keeps its own column name."""
    cols = sc.numeric_columns(df)
    params = enc.fit_robust(df, cols, method=quantile_method, store=True)
    return enc.apply_robust(df, params)
