"""Registered queries: one per operator of the inventory.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the full test
tables (or data Spark derives from them).  Floating outputs are rounded
(``round_doubles``) only as output formatting for the engine comparison.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast import schema as S
from tillcast.operators import filters as flt
from tillcast.operators import seasonal as sea
from tillcast.functions.calendar import with_cyclic
from tillcast.functions.scalars import select_facts
from tillcast.plans.frames import round_doubles
from tillcast.operators.joins import build_star
from tillcast.plans.star import (denorm_dashboard, denorm_ml, fact_measures, get_dashboard, get_ml, hops,
                                 join_bushy)
from tillcast.sources import standin as st
from tillcast.sources.tables import data_version, date_range

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MINIMAL_RANGE = ("1996-01-01", "1996-12-31")


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def ml(spark: SparkSession, d: str, *columns: str, **kw) -> DataFrame:
    """Columns of the ML star; only the joins that they need are planned."""
    return denorm_ml(spark, d, columns=columns, **kw)


# --------------------------------------------------------------- 2.1 / 2.4
@query("denorm_ml")
def q_denorm_ml(spark, d):
    return denorm_ml(spark, d)


@query("denorm_dashboard")
def q_denorm_dashboard(spark, d):
    return denorm_dashboard(spark, d)


@query("join_bushy")
def q_join_bushy(spark, d):
    return join_bushy(spark, d)


@query("get_ml")
def q_get_ml(spark, d):
    return get_ml(spark, d, *MINIMAL_RANGE)


@query("get_dashboard")
def q_get_dashboard(spark, d):
    return get_dashboard(spark, d, *MINIMAL_RANGE)


@query("join_promotion")
def q_join_promotion(spark, d):
    """The fact with a promotion table (given as a table, not projected)."""
    return build_star(st.fact_sales(spark, d), [hops(spark, d)["promotion"]],
                      ["SalesKey", "PromotionKey", "DiscountPercent", "PromotionName", "PromotionType"])


@query("join_date")
def q_join_date(spark, d):
    """The fact with a calendar table (given as a table, not projected)."""
    return build_star(st.fact_sales(spark, d), [hops(spark, d)["date"]],
                      ["SalesKey", "DateKey", "CalendarYear", "CalendarQuarterLabel", "CalendarWeekLabel",
                       "MonthNumber", "CalendarDayOfWeekNumber", "IsWorkDay"])


@query("date_range")
def q_date_range(spark, d):
    return date_range(ml(spark, d, "SalesKey", "DateKey", "SalesAmount"), *MINIMAL_RANGE)


@query("sample_rows")
def q_sample_rows(spark, d):
    return ml(spark, d, "SalesKey", "DateKey", "SalesAmount", ratio=0.5, seed=42)


@query("select_facts")
def q_select_facts(spark, d):
    return select_facts(ml(spark, d, "DateKey", *S.FACT_COLUMNS), with_datekey=True)


# --------------------------------------------------------------------- 2.3
@query("clean_outliers")
def q_clean_outliers(spark, d):
    return flt.clean_outliers(ml(spark, d, "SalesKey", "DateKey", "SalesAmount"), stats_df=fact_measures(spark, d))


# ------------------------------------------------------------ minimal slice
def daily_revenue(spark: SparkSession, d: str, lo: str = MINIMAL_RANGE[0],
                  hi: str = MINIMAL_RANGE[1]) -> DataFrame:
    """Daily revenue features for a date range: star -> range -> 2.5 sigma
    filter -> cyclic month -> daily aggregate."""
    star = ml(spark, d, "DateKey", "SalesAmount", "SalesQuantity", "DiscountAmount", "IsWorkDay",
              "MonthNumber", min_date=lo, max_date=hi)
    clean = flt.clean_outliers(star, stats_df=fact_measures(spark, d, min_date=lo, max_date=hi))
    feats = with_cyclic(clean, "MonthNumber", S.MONTHS_IN_YEAR)
    daily = feats.groupBy("DateKey").agg(
        sea.money_sum("SalesAmount"),
        F.sum("SalesQuantity").alias("SalesQuantity"),
        sea.money_sum("DiscountAmount"),
        F.avg(F.when(F.col("IsWorkDay") == "WorkDay", 1.0).otherwise(0.0)).alias("workday_share"),
        F.min_by("sin_MonthNumber", "DateKey").alias("sin_MonthNumber"),
        F.count(F.lit(1)).alias("n_sales"))
    return round_doubles(daily)


@query("daily_revenue")
def q_daily_revenue(spark, d):
    return daily_revenue(spark, d)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """The daily feature table of the preprocess pipeline (star -> 2.5 sigma
    clean -> encoders fitted on the cleaned rows -> daily features joined
    with the daily revenue target)."""
    return round_doubles(pl.pipeline_preprocess(spark, d).daily)


# ------------------------------------------------------- 2.2 / 2.9 scalars
from tillcast.functions import scalars as scl  # noqa: E402
from tillcast.functions.calendar import create_facts, cyclic, date_spine_of  # noqa: E402
from tillcast.operators import features as fea  # noqa: E402


def _prepared(spark, d):
    return fea.prepare_rows(denorm_ml(spark, d))


@query("impute_const")
def q_impute_const(spark, d):
    return scl.impute_const(ml(spark, d, "SalesKey", *S.IMPUTE_ZERO_COLUMNS))


@query("fill_na_label")
def q_fill_na_label(spark, d):
    return scl.fill_na_label(ml(spark, d, "SalesKey", "BrandName"))


@query("strip_strings")
def q_strip_strings(spark, d):
    return scl.strip_strings(ml(spark, d, "SalesKey", "BrandName", "StoreType", "CityName",
                                "WeightUnitMeasureID", "IsWorkDay"))


@query("promo_flag")
def q_promo_flag(spark, d):
    return ml(spark, d, "SalesKey", "PromotionKey").select("SalesKey", scl.promo_flag(F.col("PromotionKey"))
                                      .alias("PromotionKey"))


@query("stock_swap")
def q_stock_swap(spark, d):
    return ml(spark, d, "SalesKey", "StockTypeID").select("SalesKey", scl.stock_swap(F.col("StockTypeID"))
                                      .alias("StockTypeID"))


@query("weight_to_grams")
def q_weight_to_grams(spark, d):
    star = ml(spark, d, "SalesKey", "Weight", "WeightUnitMeasureID")
    return round_doubles(star.select("SalesKey", scl.weight_to_grams(
        F.col("Weight"), F.col("WeightUnitMeasureID")).alias("Weight_grams")))


@query("quarter_number")
def q_quarter_number(spark, d):
    return ml(spark, d, "SalesKey", "CalendarQuarterLabel").select(
        "SalesKey", scl.quarter_number(F.col("CalendarQuarterLabel")).alias("quarter"))


def _cyclic_query(col_expr, period: int, name: str):
    def fn(spark, d):
        star = ml(spark, d, "SalesKey", name)
        s, c = cyclic(col_expr(), period)
        return round_doubles(star.select("SalesKey", s.alias(f"sin_{name}"),
                                         c.alias(f"cos_{name}")))
    return fn


QUERIES["cyclic_month"] = _cyclic_query(lambda: F.col("MonthNumber"), S.MONTHS_IN_YEAR,
                                        "MonthNumber")
QUERIES["cyclic_dow"] = _cyclic_query(lambda: F.col("CalendarDayOfWeekNumber"), S.DAYS_IN_WEEK,
                                      "CalendarDayOfWeekNumber")
QUERIES["cyclic_quarter"] = _cyclic_query(
    lambda: scl.quarter_number(F.col("CalendarQuarterLabel")), S.QUARTERS_IN_YEAR,
    "CalendarQuarterLabel")


@query("prepare_rows")
def q_prepare_rows(spark, d):
    """All columns; only those that the chain computes are rounded."""
    return round_doubles(_prepared(spark, d), exclude=S.ML_COLUMNS)


@query("date_spine")
def q_date_spine(spark, d):
    return date_spine_of(ml(spark, d, "DateKey"))


@query("create_facts")
def q_create_facts(spark, d):
    return round_doubles(create_facts(date_spine_of(ml(spark, d, "DateKey"))))


@query("drop_nulls")
def q_drop_nulls(spark, d):
    return flt.drop_nulls(denorm_ml(spark, d))


@query("nonzero_filter")
def q_nonzero_filter(spark, d):
    return flt.nonzero_filter(ml(spark, d, "SalesKey", "ReturnAmount"), "ReturnAmount")


@query("threshold_count")
def q_threshold_count(spark, d):
    return flt.threshold_count(denorm_ml(spark, d), "SalesAmount", 90000.0)


@query("key_value_filter")
def q_key_value_filter(spark, d):
    star = ml(spark, d, "SalesKey", "DateKey", "SalesAmount", "StoreType", "channelKey")
    return flt.key_value_filter(star, ["StoreType", "channelKey"], ["BUILDING", "2"]).select(
        "SalesKey", "DateKey", "SalesAmount")


# ------------------------------------------------------ 2.11 fitted encoders
from tillcast.operators import encoders as enc  # noqa: E402


@query("robust_scale")
def q_robust_scale(spark, d):
    p = _prepared(spark, d)
    params = enc.fit_robust(p, S.ROBUST_SCALE_COLUMNS, store=True)
    out = enc.apply_robust(p, params, rename={"CalendarYear": fea.SCALED_YEAR})
    cols = [fea.SCALED_YEAR if c == "CalendarYear" else c for c in S.ROBUST_SCALE_COLUMNS]
    return round_doubles(out.select("SalesKey", *cols))


@query("one_hot")
def q_one_hot(spark, d):
    p = _prepared(spark, d)
    params = enc.fit_onehot(p, S.ONE_HOT_COLUMNS)
    out = enc.apply_onehot(p, params)
    return out.select("SalesKey", *params.output_columns())


@query("one_hot_ignore")
def q_one_hot_ignore(spark, d):
    """Categories of a year without one store type applied to all rows: the unseen
    type is all zero."""
    p = _prepared(spark, d)
    params = enc.fit_onehot(p.where("CalendarYear = 1996 AND StoreType <> 'BUILDING'"), ["BrandName", "StoreType"], handle_unknown="ignore")
    return enc.apply_onehot(p, params).select("SalesKey", *params.output_columns())


@query("one_hot_long")
def q_one_hot_long(spark, d):
    return enc.onehot_long(ml(spark, d, "SalesKey", "BrandName", "CityName"), ["SalesKey"], ["BrandName", "CityName"])


@query("rename_column")
def q_rename_column(spark, d):
    return scl.rename_column(ml(spark, d, "SalesKey", "SalesAmount"), "SalesAmount", "Revenue")


@query("parse_date")
def q_parse_date(spark, d):
    """Text to date, by the format of the text."""
    text = ml(spark, d, "SalesKey", "DateKey").withColumn("text", F.date_format("DateKey", "yyyy/MM/dd"))
    return text.select("SalesKey", scl.parse_date(F.col("text"), "yyyy/MM/dd").alias("DateKey"))


@query("select_numeric")
def q_select_numeric(spark, d):
    return scl.select_numeric(denorm_ml(spark, d))


@query("preprocess_features")
def q_preprocess_features(spark, d):
    """The one-call form on the rows of the star; a sum of each scaled or coded
    column by day, so that every row counts."""
    rows = fea.preprocess_features(denorm_ml(spark, d))
    return round_doubles(sea.seasonalize(rows, "monthly"))


@query("ln_exp")
def q_ln_exp(spark, d):
    """The series on the ln scale and back."""
    split = ts.chrono_split_series(daily_series(spark, d), as_log=True)
    return round_doubles(ts.exp_restore(split.select("DateKey", "log_y"), "log_y"), 0)


@query("label_encode")
def q_label_encode(spark, d):
    p = _prepared(spark, d)
    params = enc.fit_label(p, S.LABEL_COLUMNS)
    return enc.apply_label(p, params).select("SalesKey", *S.LABEL_COLUMNS)


@query("simple_preprocess")
def q_simple_preprocess(spark, d):
    return round_doubles(fea.simple_preprocess(denorm_ml(spark, d)))


# --------------------------------------------------------- 2.5 grain aggregates
def features(spark: SparkSession, d: str, min_date: str | None = None,
             max_date: str | None = None, clean: bool = False) -> DataFrame:
    star = denorm_ml(spark, d, min_date=min_date, max_date=max_date)
    if clean:
        star = flt.clean_outliers(star)
    return fea.fit_transform(star, drop=["SalesKey"])[1]


def keys_of(grain: str) -> list[str]:
    return list(dict.fromkeys(["DateKey", *S.GRAIN_KEYS[grain]]))


def _seasonalize_query(grain: str):
    def fn(spark, d):
        return round_doubles(sea.seasonalize(features(spark, d), grain))
    return fn


def _seasonalize_y_query(grain: str):
    def fn(spark, d):
        return sea.seasonalize_y(ml(spark, d, *keys_of(grain), "SalesAmount"), grain)
    return fn


def _seasonal_simple_query(grain: str, full: bool = False):
    def fn(spark, d):
        spec = {**sea.SIMPLE_AGGS, **(sea.FULL_EXTRA_AGGS if full else {})}
        star = ml(spark, d, *keys_of(grain), *[c for c in spec if c in S.ML_COLUMNS])
        return round_doubles(sea.seasonal_simple(star, grain, full=full),
                             exclude=sea.MONEY_COLUMNS)
    return fn


for _g in S.GRAINS:
    QUERIES[f"seasonalize_{_g}"] = _seasonalize_query(_g)
    QUERIES[f"seasonalize_y_{_g}"] = _seasonalize_y_query(_g)
    QUERIES[f"seasonal_simple_{_g}"] = _seasonal_simple_query(_g)
QUERIES["seasonal_full_daily"] = _seasonal_simple_query("daily", full=True)


@query("multi_grain")
def q_multi_grain(spark, d):
    return round_doubles(sea.multi_grain(ml(spark, d, *sea.ALL_GRAIN_KEYS, *sea.SIMPLE_AGGS)), exclude=sea.MONEY_COLUMNS)


@query("grouped_forecast_agg")
def q_grouped_forecast_agg(spark, d):
    return round_doubles(sea.grouped_agg(ml(spark, d, "DateKey", "StoreType", "SalesAmount"), ["StoreType"]))


@query("group_all_sum")
def q_group_all_sum(spark, d):
    return round_doubles(sea.group_all_sum(denorm_ml(spark, d), "DateKey"), 4)


# ------------------------------------------------------------ 2.5 profiling
from tillcast.operators import profile as prof  # noqa: E402
from tillcast.operators import timeseries as ts  # noqa: E402
from tillcast.operators.ranking import every_nth, lag_rows  # noqa: E402

# The numeric columns of the ML star.
NUMERIC = ["channelKey", "StoreKey", "ProductKey", "PromotionKey", "UnitCost", "UnitPrice", "SalesQuantity",
           "ReturnQuantity", "ReturnAmount", "DiscountQuantity", "DiscountAmount", "TotalCost", "SalesAmount",
           "DiscountPercent", "CalendarYear", "MonthNumber", "CalendarDayOfWeekNumber", "ProductSubcategoryKey",
           "ClassID", "StyleID", "ColorID", "Weight", "StockTypeID", "ProductCategoryKey", "GeographyKey",
           "EmployeeCount", "SellingAreaSize"]


@query("global_stats")
def q_global_stats(spark, d):
    return prof.global_stats(ml(spark, d, "SalesAmount")).withColumn("std", F.round("std", 4))


@query("describe")
def q_describe(spark, d):
    star = ml(spark, d, *NUMERIC)
    out = prof.describe(star, NUMERIC)
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "std")}).transform(round_doubles)


@query("null_counts")
def q_null_counts(spark, d):
    return prof.null_counts(denorm_ml(spark, d))


@query("shape_schema")
def q_shape_schema(spark, d):
    """Row count, column count and type of every column of the ML star."""
    return prof.shape_schema(denorm_ml(spark, d))


@query("value_counts")
def q_value_counts(spark, d):
    return prof.value_counts(ml(spark, d, "StoreType"), "StoreType")


@query("distinct_values")
def q_distinct_values(spark, d):
    return prof.distinct_values(ml(spark, d, "BrandName"), "BrandName")


@query("count_distinct")
def q_count_distinct(spark, d):
    return prof.count_distinct(ml(spark, d, "DateKey"), "DateKey")


@query("min_value")
def q_min_value(spark, d):
    return prof.min_value(ml(spark, d, "SalesAmount"), "SalesAmount")


@query("histogram")
def q_histogram(spark, d):
    return round_doubles(prof.histogram(ml(spark, d, "SalesAmount"), "SalesAmount", 30))


@query("box_stats")
def q_box_stats(spark, d):
    return round_doubles(prof.box_stats(ml(spark, d, "SalesAmount"), "SalesAmount"))


@query("outliers_zscore")
def q_outliers_zscore(spark, d):
    return round_doubles(flt.zscore_summary(ml(spark, d, "SalesAmount"), "SalesAmount"))


@query("outliers_iqr")
def q_outliers_iqr(spark, d):
    return flt.outliers_iqr(ml(spark, d, "SalesKey", "DiscountAmount"), "DiscountAmount")


@query("outliers_quantile")
def q_outliers_quantile(spark, d):
    return flt.outliers_quantile(ml(spark, d, "SalesKey", "SalesAmount"), "SalesAmount")


@query("correlation_pairs")
def q_correlation_pairs(spark, d):
    return round_doubles(prof.correlation_pairs(ml(spark, d, *NUMERIC), NUMERIC))


@query("top_correlated_pairs")
def q_top_correlated_pairs(spark, d):
    return round_doubles(prof.top_correlated_pairs(ml(spark, d, *NUMERIC), NUMERIC, 10))


@query("anderson_darling")
def q_anderson_darling(spark, d):
    out = prof.anderson_darling(ml(spark, d, "SalesAmount"), "SalesAmount")
    return out.withColumn("statistic", F.round("statistic", 4)).transform(round_doubles)


# ------------------------------------------------- 2.6 time-series operators
def daily_series(spark: SparkSession, d: str) -> DataFrame:
    """(DateKey, SalesAmount): the daily revenue series of the whole star."""
    star = ml(spark, d, "DateKey", "SalesAmount")
    # one row per day (calendar-bounded): few partitions for the windows
    return star.groupBy("DateKey").agg(sea.money_sum("SalesAmount")).coalesce(
        spark.sparkContext.defaultParallelism)


@query("lag_baseline")
def q_lag_baseline(spark, d):
    return round_doubles(ts.lag_baseline(daily_series(spark, d)))


@query("lag_baseline_rows")
def q_lag_baseline_rows(spark, d):
    star = ml(spark, d, "SalesKey", "SalesAmount")
    pred = lag_rows(star, "SalesAmount", ["SalesKey"])
    return round_doubles(ts.r2_by(pred, "SalesAmount", "y_pred"))


@query("diff")
def q_diff(spark, d):
    return round_doubles(ts.diff(daily_series(spark, d)))


@query("diff_backfill")
def q_diff_backfill(spark, d):
    return round_doubles(ts.diff_backfill(daily_series(spark, d)))


@query("chrono_split")
def q_chrono_split(spark, d):
    return ts.chrono_split_series(daily_series(spark, d)).select("DateKey", "rn", "is_train")


@query("log_split")
def q_log_split(spark, d):
    out = ts.chrono_split_series(daily_series(spark, d), as_log=True)
    return round_doubles(out.select("DateKey", "log_y", "is_train"))


@query("every_nth")
def q_every_nth(spark, d):
    star = ml(spark, d, "SalesKey", "SalesAmount")
    return every_nth(star, ["SalesKey"], 500)


def _decompose_query(model: str):
    def fn(spark, d):
        out = ts.decompose(daily_series(spark, d), period=365, model=model, money=True)
        return round_doubles(out.select("DateKey", "trend", "seasonal", "resid"))
    return fn


QUERIES["decompose_additive"] = _decompose_query("additive")
QUERIES["decompose_multiplicative"] = _decompose_query("multiplicative")


@query("deseasonalize")
def q_deseasonalize(spark, d):
    out = ts.decompose(daily_series(spark, d), period=365, model="multiplicative", money=True)
    # money-scale output (~1e6): rounded to cents
    return round_doubles(ts.deseasonalize(out).select("DateKey", "deseasonalized"), 2)


@query("acf")
def q_acf(spark, d):
    return round_doubles(ts.acf(daily_series(spark, d), nlags=30))


@query("pacf")
def q_pacf(spark, d):
    return round_doubles(ts.pacf(panel(spark, d, "week"), ds="ds", keys=PANEL, nlags=30))


@query("sort_by_date")
def q_sort_by_date(spark, d):
    return daily_series(spark, d).orderBy("DateKey")


@query("head")
def q_head(spark, d):
    return daily_series(spark, d).orderBy("DateKey").limit(10)


@query("zip_dates")
def q_zip_dates(spark, d):
    """Calendar spine over the data's date range, left-joined to the daily
    series (a missing day yields a null, never a shifted value)."""
    series = daily_series(spark, d)
    spine = date_spine_of(series)
    return spine.join(series, "DateKey", "left")


# ---------------------------------------------------- 2.12 models, metrics
from tillcast.operators import forecast as fc  # noqa: E402
from tillcast.operators import model as mdl  # noqa: E402
from tillcast.operators import marginals as mar  # noqa: E402
from tillcast.operators import neighbours as knn  # noqa: E402
from tillcast.operators import registry as reg  # noqa: E402
from tillcast.operators import sarima as sar  # noqa: E402
from tillcast.operators import synth as syn  # noqa: E402
from tillcast.operators.metrics import mean_baseline, metrics  # noqa: E402
from tillcast.plans import pipelines as pl  # noqa: E402
from tillcast.sources import sinks  # noqa: E402
from tillcast.sources.tables import read_range, scan_csv, select_except  # noqa: E402

TRAIN_END, TEST_START, TEST_END = "2000-12-31", "2001-01-01", "2001-11-04"


def _round_metrics(m: DataFrame) -> DataFrame:
    """Money-scale errors to cents (MSE, in squared money, to units)."""
    return m.withColumns({"mae": F.round("mae", 2), "rmse": F.round("rmse", 2),
                          "mse": F.round("mse", 0), "r2": F.round("r2", 6)})


@query("metrics")
def q_metrics(spark, d):
    """MAE / MSE / RMSE / R^2 of the previous-day forecast of daily revenue."""
    s = daily_series(spark, d).withColumn(
        "prediction", F.lag("SalesAmount").over(Window.orderBy("DateKey")))
    return _round_metrics(metrics(s.where(F.col("prediction").isNotNull()), "SalesAmount",
                                  "prediction"))


@query("mean_baseline")
def q_mean_baseline(spark, d):
    split = ts.chrono_split_series(daily_series(spark, d))
    return _round_metrics(mean_baseline(split.where("is_train"),
                                        split.where(~F.col("is_train"))))


@query("holdout_split")
def q_holdout_split(spark, d):
    return mdl.holdout_split(daily_series(spark, d), 0.1).select("DateKey", "is_train")


def processed(spark: SparkSession, d: str, lo: str | None = None, hi: str | None = None
              ) -> pl.Processed:
    return pl.pipeline_preprocess(spark, d, lo, hi)


@query("pipeline_preprocess")
def q_pipeline_preprocess(spark, d):
    return round_doubles(processed(spark, d).daily)


@query("attach_target")
def q_attach_target(spark, d):
    return round_doubles(processed(spark, d).daily.select("DateKey", "CalendarYear",
                                                         "SalesQuantity", "SalesAmount"))


def trained(spark: SparkSession, d: str) -> tuple[pl.Processed, pl.Trained]:
    """Daily table and model of all days up to TRAIN_END: the newest saved
    model, or a new one if none is saved for these tables."""
    proc = processed(spark, d, None, TRAIN_END)
    version = data_version(spark, d, ["lineitem", "orders", "part", "supplier", "customer"])
    root = sinks.warehouse_dir(spark) + "/models-" + sinks.cache_key(d, version, TRAIN_END)
    found = pl.train_or_load(proc.daily, root)
    assert found is not None
    return proc, found


@query("train_gbt")
def q_train_gbt(spark, d):
    daily = processed(spark, d).daily
    split = mdl.holdout_split(daily, 0.1)
    res = mdl.train_gbt(split.where("is_train").drop("is_train"), "SalesAmount",
                        split.where(~F.col("is_train")).drop("is_train"))
    return res.history.withColumn("best_iter", F.lit(res.best_iter))


@query("predict")
def q_predict(spark, d):
    proc, m = trained(spark, d)
    return pl.pipeline_predict(spark, d, proc, m.model, m.features, TEST_START, TEST_END)


@query("forecast_past")
def q_forecast_past(spark, d):
    proc, m = trained(spark, d)
    return pl.forecast_past(spark, d, proc, m.model, m.features, TEST_START, TEST_END)


@query("forecast")
def q_forecast(spark, d):
    """Past days from actual features, days after the last actual date from
    synthetic features (straddling range)."""
    proc, m = trained(spark, d)
    cop = pl.fit_synthesizer(proc.daily)
    last = proc.daily.agg(F.max("DateKey")).first()[0].isoformat()
    return pl.forecast(spark, d, proc, m.model, m.features, cop, "2000-12-01", "2001-01-31", last)


def _grouped_past(spark, d):
    proc, m = trained(spark, d)
    return pl.forecast_past(spark, d, proc, m.model, m.features, TEST_START, TEST_END, filters={"channelKey": 2}, groups=["StoreType"])


@query("forecast_past_grouped")
def q_forecast_past_grouped(spark, d):
    """Of one channel's sales, for each store type and day."""
    return _grouped_past(spark, d)


@query("forecast_past_keys")
def q_forecast_past_keys(spark, d):
    """The days of each group, and which of them have a prediction."""
    return _grouped_past(spark, d).select("DateKey", "StoreType", F.col("prediction").isNotNull().alias("predicted"))


def _grouped_forecast(spark, d):
    proc, m = trained(spark, d)
    last = proc.daily.agg(F.max("DateKey")).first()[0].isoformat()
    return pl.forecast(spark, d, proc, m.model, m.features, pl.fit_synthesizer(proc.daily), "2000-12-01", "2001-01-31", last,
                       filters={"channelKey": 2}, groups=["StoreType", "ContinentName"])


@query("forecast_grouped")
def q_forecast_grouped(spark, d):
    """Of one channel's sales, for each store type and continent, past and
    synthetic days."""
    return _grouped_forecast(spark, d)


@query("forecast_keys")
def q_forecast_keys(spark, d):
    """The days of each group and where their prediction comes from."""
    return _grouped_forecast(spark, d).select("DateKey", "StoreType", "ContinentName", "source")


@query("pipeline_train_run")
def q_pipeline_train_run(spark, d):
    """The run that a training saved: its context and its rows."""
    runs = sinks.warehouse_dir(spark) + "/registry-" + sinks.cache_key(d) + "/runs"
    if not sinks._fs_exists(spark, runs) or reg.latest_by_name(reg.read_runs(spark, runs), "train").first() is None:
        q_pipeline_train(spark, d)
    return reg.latest_by_name(reg.read_runs(spark, runs), "train").select("context", "row_count")


@query("pipeline_train")
def q_pipeline_train(spark, d):
    root = sinks.warehouse_dir(spark) + "/registry-" + sinks.cache_key(d)
    pl.pipeline_train(processed(spark, d).daily, 0.1, runs_path=root + "/runs", model_root=root + "/models")
    return reg.latest_by_name(reg.read_runs(spark, root + "/runs"), "train").select(
        "context", "row_count", F.col("mae").alias("val_mae"))


@query("pipeline_evaluate")
def q_pipeline_evaluate(spark, d):
    """Metrics of the newest model on the year after the days that it was
    trained on."""
    root = sinks.warehouse_dir(spark) + "/registry-" + sinks.cache_key(d)
    proc, m = trained(spark, d)
    test = pl.daily_features(denorm_ml(spark, d, min_date=TEST_START, max_date=TEST_END), proc.features)
    target = sea.seasonalize_y(ml(spark, d, "DateKey", "SalesAmount", min_date=TEST_START, max_date=TEST_END), "daily", ordered=False)
    return _round_metrics(pl.pipeline_evaluate(test.join(target, "DateKey"), m.model, m.features, TEST_START,
                                               TEST_END, runs_path=root + "/runs"))


def _train_rows(spark, d) -> DataFrame:
    """Row features of the cleaned sales, with the target."""
    rows = flt.clean_outliers(denorm_ml(spark, d), stats_df=fact_measures(spark, d))
    feats = fea.fit_transform(rows, drop=["SalesKey"])[1]
    return sinks.stored(feats.select("DateKey", *mdl.feature_columns(feats), "SalesAmount"), "rows")


@query("cross_validate")
def q_cross_validate(spark, d):
    """Trees of depth 10 on the sales rows, contiguous folds in date order."""
    return mdl.cross_validate(_train_rows(spark, d), k=5, kind="tree", max_depth=10)


@query("learning_curve")
def q_learning_curve(spark, d):
    """Trees of depth 10 on the sales rows, a tenth to a half of each fold's days."""
    return mdl.learning_curve(_train_rows(spark, d), fractions=(0.1, 0.3, 0.5), k=5,
                              kind="tree", max_depth=10)


@query("train_forest")
def q_train_forest(spark, d):
    """Forests of 10 trees of depth 10 on the sales rows, folds as in ``cross_validate``."""
    return mdl.cross_validate(_train_rows(spark, d), k=5, kind="forest", n_trees=10,
                              max_depth=10)


KNN_FEATURES = ["UnitCost", "UnitPrice", "TotalCost", "ReturnQuantity", "ReturnAmount", "DiscountQuantity", "DiscountAmount",
                "DiscountPercent", "Weight_grams", "EmployeeCount", "SellingAreaSize"]


@query("bagged_knn")
def q_bagged_knn(spark, d):
    """Three bagged regressors of the five nearest sales on the scaled measures,
    trained on the first tenth and the first 30 % of the days and scored on
    the last fifth; ``share`` of the pairs whose distance was computed."""
    rows = sinks.stored(_train_rows(spark, d).select("DateKey", *KNN_FEATURES, "SalesAmount").withColumn("id", F.monotonically_increasing_id()), "knn")
    test = rows.where(F.col("DateKey") >= F.to_date(F.lit(mdl.cut_date_at(rows, 0.8))))
    parts = []
    for part in (0.1, 0.3):
        train = rows.where(F.col("DateKey") < F.to_date(F.lit(mdl.cut_date_at(rows, part))))
        scored = test.join(knn.bagged_knn(train, test, KNN_FEATURES, "SalesAmount").withColumnRenamed("query", "id"), "id")
        scored = sinks.stored(scored.select("SalesAmount", "prediction", "compared"), "knn-scored")
        size = train.agg(F.count("*").alias("n_train"))       # one row
        work = scored.agg(F.sum("compared").alias("compared"))
        parts.append(_round_metrics(metrics(scored, "SalesAmount", "prediction")).crossJoin(F.broadcast(size)).crossJoin(F.broadcast(work))
                     .select(F.lit(part).alias("fraction"), "n_train", "n", "mae", "r2",
                             F.round(F.col("compared") / (3 * F.col("n") * F.col("n_train")), 3).alias("share")))
    return parts[0].union(parts[1])


@query("latest_by_time")
def q_latest_by_time(spark, d):
    """Evaluation runs of the previous-day baseline, one for each year of the
    daily series in the order of the years, each saved by itself; then the
    newest run overall and the newest of one context."""
    root = f"{sinks.warehouse_dir(spark)}/runs-{uuid.uuid4().hex}"
    s = daily_series(spark, d).withColumn(
        "prediction", F.lag("SalesAmount").over(Window.orderBy("DateKey")))
    by_year = metrics(s.where(F.col("prediction").isNotNull())
                      .withColumn("year", F.year("DateKey")), "SalesAmount", "prediction",
                      ["year"])
    for r in sorted(by_year.collect(), key=lambda r: r["year"]):   # a row for each year
        reg.save_run(spark, root, f"baseline_{r['year']}", 1.0, r["n"], r["mae"], {"rmse": r["rmse"], "r2": r["r2"]})
    runs = reg.read_runs(spark, root)
    newest = reg.latest_by_time(runs).select(F.lit("latest").alias("pick"), "context",
                                             "row_count", "mae")
    named = reg.latest_by_name(runs, "baseline_1996").select(
        F.lit("baseline_1996").alias("pick"), "context", "row_count", "mae")
    return newest.unionByName(named).withColumn("mae", F.round("mae", 2))


# ------------------------------------------------------ 2.6 forecasting (P3)
PANEL = ["StoreType", "ContinentName"]


def panel(spark: SparkSession, d: str, step: str) -> DataFrame:
    """Revenue of each store type and continent by week, month or quarter
    (``ds``: the period's first day); periods that the data's first and last
    day cut are left out."""
    star = ml(spark, d, "DateKey", *PANEL, "SalesAmount").where("StoreType IS NOT NULL AND ContinentName IS NOT NULL")
    ends = ml(spark, d, "DateKey").agg(F.min("DateKey").alias("lo"), F.max("DateKey").alias("hi"))   # one row
    start = F.date_trunc(step, "DateKey").cast("date")
    after = {"week": F.date_add("ds", 7), "month": F.add_months("ds", 1), "quarter": F.add_months("ds", 3)}[step]
    sums = star.groupBy(*PANEL, start.alias("ds")).agg(sea.money_sum("SalesAmount"))
    return sums.crossJoin(F.broadcast(ends)).where((F.col("ds") >= F.col("lo")) & (after <= F.date_add("hi", 1))).drop("lo", "hi")


@query("ar_forecast")
def q_ar_forecast(spark, d):
    return fc.ar_forecast(panel(spark, d, "week"), ds="ds", keys=PANEL, order=fc.ArOrder(p=3, trend=True), horizon=8, step="week")


@query("ar1_forecast")
def q_ar1_forecast(spark, d):
    """Order 1 without a trend: the closed form is simple regression."""
    out = fc.ar_forecast(panel(spark, d, "month"), ds="ds", keys=PANEL, order=fc.ArOrder(p=1, trend=False), horizon=3, step="month")
    return out.select(*PANEL, "ds", "step", F.round("yhat", 2).alias("yhat"))


@query("seasonal_ar_forecast")
def q_seasonal_ar_forecast(spark, d):
    return fc.ar_forecast(panel(spark, d, "month"), ds="ds", keys=PANEL, order=fc.ArOrder(p=1, seasonal_p=1, m=12, d=0),
                          horizon=6, log=True, step="month")


@query("seasonal_ar_forecast_weekly")
def q_seasonal_ar_forecast_weekly(spark, d):
    return fc.ar_forecast(panel(spark, d, "week"), ds="ds", keys=PANEL,
                          order=fc.ArOrder(p=1, seasonal_p=1, m=52), horizon=8, log=True, step="week")


@query("seasonal_ar_forecast_quarterly")
def q_seasonal_ar_forecast_quarterly(spark, d):
    return fc.ar_forecast(panel(spark, d, "quarter"), ds="ds", keys=PANEL,
                          order=fc.ArOrder(p=1, seasonal_p=1, m=4, trend=False), horizon=4, log=True, step="quarter")


@query("ar_backtest")
def q_ar_backtest(spark, d):
    """Fit on the first 70 % of the months (differenced, ln), compared with the
    rest on the revenue's own scale."""
    return fc.ar_backtest(panel(spark, d, "month"), ds="ds", keys=PANEL, order=fc.ArOrder(p=2, d=1, trend=False), log=True, step="month")


@query("order_search")
def q_order_search(spark, d):
    return fc.order_search(panel(spark, d, "week"), ds="ds", keys=PANEL, max_p=6, seasonal_ps=(0, 1), m=52, step="week")


REVENUE = {"ds": "ds", "keys": PANEL}


@query("sarima_forecast")
def q_sarima_forecast(spark, d):
    """ARIMA(1,1,2) of the logarithm, with a 95 % interval, eight weeks ahead."""
    return sar.sarima_forecast(panel(spark, d, "week"), **REVENUE, order=sar.Order(1, 1, 2, trend="n"), horizon=8, log=True, step="week")


@query("sarima_seasonal_forecast")
def q_sarima_seasonal_forecast(spark, d):
    """Seasonal ARIMA (1,0,1)(1,0,1) over twelve months, half a year ahead."""
    return sar.sarima_forecast(panel(spark, d, "month"), **REVENUE, order=sar.Order(1, 0, 1, 1, 0, 1, 12), horizon=6, log=True, step="month")


@query("sarima_search")
def q_sarima_search(spark, d):
    """Stepwise search of p, d, q and a constant on the logarithm, monthly, and of
    the seasonal orders too by quarter."""
    monthly = sar.sarima_search(panel(spark, d, "month"), **REVENUE, log=True, step="month", max_d=3)
    quarterly = sar.sarima_search(panel(spark, d, "quarter"), **REVENUE, log=True, step="quarter", max_p=2, max_q=2, max_P=1, max_Q=1, m=4)
    return monthly.withColumn("step", F.lit("month")).unionByName(quarterly.withColumn("step", F.lit("quarter")))


@query("sarima_backtest")
def q_sarima_backtest(spark, d):
    """ARIMA(1,1,2) of the logarithm fitted on the first 70 % of the weeks, compared
    with the rest on the revenue's own scale."""
    return sar.sarima_backtest(panel(spark, d, "week"), **REVENUE, order=sar.Order(1, 1, 2, trend="n"), log=True, step="week")


@query("adf_statistic")
def q_adf_statistic(spark, d):
    """The statistic with one lagged difference, monthly."""
    out = fc.adf_test(panel(spark, d, "month"), ds="ds", keys=PANEL, lags=1, step="month")
    return out.select(*PANEL, F.round("adf", 4).alias("adf"), "nobs")


@query("adf_test")
def q_adf_test(spark, d):
    """Of each series, of its first difference and of its residual after
    decomposition; the lag order is the one of the lowest AIC."""
    s = panel(spark, d, "week")
    raw = fc.adf_test(s, ds="ds", keys=PANEL, step="week").withColumn("series", F.lit("raw"))
    diff = fc.adf_test(s, ds="ds", keys=PANEL, diff_first=True, step="week").withColumn("series", F.lit("difference"))
    resid = ts.decompose(s, ds="ds", keys=PANEL, period=52)
    resid = fc.adf_test(resid, y="resid", ds="ds", keys=PANEL, step="week").withColumn("series", F.lit("residual"))
    return raw.unionByName(diff).unionByName(resid)


# ------------------------------------------------------------ 2.13 synthesis
MEASURES = ["UnitCost", "UnitPrice", "SalesQuantity", "ReturnAmount", "DiscountAmount", "TotalCost", "SalesAmount"]


def _copula_daily(spark, d):
    daily = processed(spark, d).daily
    return daily, pl.fit_synthesizer(daily)


@query("fit_marginals")
def q_fit_marginals(spark, d):
    """The nearest of truncated normal, gamma and beta for each measure of the
    sales rows, its parameters and its distance from the percentiles."""
    return mar.marginals_table(ml(spark, d, *MEASURES), MEASURES)


@query("sample_copula")
def q_sample_copula(spark, d):
    _daily, cop = _copula_daily(spark, d)
    return syn.sample_copula(spark, cop, factor=1, seed=7)


@query("sample_with_facts")
def q_sample_with_facts(spark, d):
    daily, cop = _copula_daily(spark, d)
    last = daily.agg(F.max("DateKey")).first()[0]
    spine = daily.sparkSession.range(1).select(F.explode(F.sequence(
        F.date_add(F.lit(last), 1), F.date_add(F.lit(last), 30))).alias("DateKey"))
    return syn.sample_with_facts(cop, create_facts(spine), "DateKey")


@query("union_actual_synth")
def q_union_actual_synth(spark, d):
    daily, cop = _copula_daily(spark, d)
    last = daily.agg(F.max("DateKey")).first()[0]
    spine = spark.range(1).select(F.explode(F.sequence(
        F.date_add(F.lit(last), 1), F.date_add(F.lit(last), 30))).alias("DateKey"))
    synth = syn.sample_with_facts(cop, create_facts(spine), "DateKey")
    return daily.withColumn("source", F.lit("actual")).unionByName(
        synth.withColumn("source", F.lit("synthetic")), allowMissingColumns=True)


@query("synthetic_quality")
def q_synthetic_quality(spark, d):
    """The full report of drawn days against actual ones: every column, every
    pair, the total."""
    daily, cop = _copula_daily(spark, d)
    synth = syn.sample_copula(spark, cop, seed=11)
    flags = [c for c in cop.output if c.startswith(tuple(f"{p}_" for p in S.ONE_HOT_COLUMNS))]
    numeric = [c for c in cop.output if c not in flags]
    work = [c for c in flags if c.startswith("IsWorkDay_")]   # of a daily table the other flags are shares
    return syn.quality_report(daily, synth, [*numeric, *[c for c in flags if c not in work]], work)


@query("diagnostic")
def q_diagnostic(spark, d):
    daily, cop = _copula_daily(spark, d)
    synth = syn.sample_copula(spark, cop, seed=5)
    triple = [c for g in cop.groups for c in g]
    return syn.diagnostic(daily, synth, [c for c in cop.output if c not in triple], triple)


@query("diagnostic_halves")
def q_diagnostic_halves(spark, d):
    """Of the sales of 1998 onwards against those before: measures by range,
    labels by category."""
    star = ml(spark, d, "CalendarYear", *MEASURES, *STAR_TEXT)
    a, b = star.where(F.col("CalendarYear") <= 1997), star.where(F.col("CalendarYear") >= 1998)
    return round_doubles(syn.diagnostic(a, b, MEASURES, STAR_TEXT))


@query("synthetic_backtest")
def q_synthetic_backtest(spark, d):
    return pl.synthetic_backtest(spark, d, TRAIN_END, TEST_START, TEST_END)


# Similarity scores between two real halves (SQL-checkable).
def _halves(spark, d):
    """The raw daily aggregates split into 1995-1997 and 1998 onwards."""
    s = sea.seasonal_simple(ml(spark, d, "DateKey", *sea.SIMPLE_AGGS), "daily")
    return s.where(F.year("DateKey") <= 1997), s.where(F.year("DateKey") >= 1998)


DAILY_NUMERIC = ["UnitCost", "UnitPrice", "ReturnQuantity", "ReturnAmount", "DiscountQuantity", "DiscountAmount",
                 "TotalCost", "SalesQuantity", "SalesAmount"]
STAR_TEXT = ["CalendarQuarterLabel", "CalendarWeekLabel", "IsWorkDay", "BrandName", "WeightUnitMeasureID", "StoreType",
             "GeographyType", "ContinentName", "CityName", "StateProvinceName", "RegionCountryName"]


@query("ks_complement")
def q_ks_complement(spark, d):
    a, b = _halves(spark, d)
    return round_doubles(syn.ks_complement(a, b, DAILY_NUMERIC))


@query("correlation_similarity")
def q_correlation_similarity(spark, d):
    a, b = _halves(spark, d)
    return round_doubles(syn.correlation_similarity(a, b, DAILY_NUMERIC))


def _star_halves(spark, d):
    star = ml(spark, d, "CalendarYear", *STAR_TEXT)
    return star.where(F.col("CalendarYear") <= 1997), star.where(F.col("CalendarYear") >= 1998)


@query("tv_complement")
def q_tv_complement(spark, d):
    a, b = _star_halves(spark, d)
    return round_doubles(syn.tv_complement(a, b, STAR_TEXT))


@query("contingency_similarity")
def q_contingency_similarity(spark, d):
    a, b = _star_halves(spark, d)
    pairs = [(x, y) for i, x in enumerate(STAR_TEXT) for y in STAR_TEXT[i + 1:]]
    return round_doubles(syn.contingency_similarity(a, b, pairs))


@query("quality_report")
def q_quality_report(spark, d):
    """Shapes, trends and total between two real halves of the daily table."""
    a, b = _halves(spark, d)
    flag = F.when(F.weekday("DateKey") < 5, "WorkDay").otherwise("WeekEnd").alias("IsWorkDay")
    a, b = (x.select(*DAILY_NUMERIC, flag) for x in (a, b))
    return round_doubles(syn.quality_report(a, b, DAILY_NUMERIC, ["IsWorkDay"]), 4)


@query("detect_metadata")
def q_detect_metadata(spark, d):
    """Column kinds of the daily table: categorical when forced (the
    discount triple, the geography type) or binary, else numerical; exact
    distinct counts (the table has one row per day)."""
    daily = round_doubles(processed(spark, d).daily)  # values as reported (6 dp)
    return syn.detect_metadata(daily, forced=pl.DISCOUNT_GROUP + ["GeographyType_City"],
                               exclude=["DateKey"])


# ---------------------------------------------------------- 2.1 sources/sinks
@query("write_csv")
def q_write_csv(spark, d):
    """Write the daily revenue series as headed CSV and scan it back with a
    declared schema."""
    path = sinks.warehouse_dir(spark) + "/csv-" + sinks.cache_key(d)
    sinks.write_csv(daily_series(spark, d), path)
    return scan_csv(spark, path, "DateKey date, SalesAmount double")


@query("write_table")
def q_write_table(spark, d):
    path = sinks.warehouse_dir(spark) + "/table-" + sinks.cache_key(d)
    sinks.write_table(daily_series(spark, d).withColumn("year", F.year("DateKey")), path,
                      truncate=True, partition_by=["year"])
    return spark.read.parquet(path).drop("year")


@query("write_clustered")
def q_write_clustered(spark, d):
    """The ML star written date-clustered (year directories) and read back."""
    path = sinks.warehouse_dir(spark) + "/star-" + sinks.cache_key(d)
    sinks.write_clustered(ml(spark, d, "SalesKey", "DateKey", "SalesAmount", "StoreType"), path)
    return sinks.read_clustered(spark, path, None, None)


@query("materialize")
def q_materialize(spark, d):
    key = sinks.cache_key("daily_series", d, data_version(spark, d, ["lineitem"]))
    return sinks.materialize(spark, key, lambda: daily_series(spark, d))


@query("materialize_filtered")
def q_materialize_filtered(spark, d):
    key = sinks.cache_key("daily_series", d, data_version(spark, d, ["lineitem"]))
    return sinks.materialize_filtered(spark, key, lambda: daily_series(spark, d),
                                      "1996-01-01", "1996-12-31")


@query("read_table_ordered")
def q_read_table_ordered(spark, d):
    return read_range(daily_series(spark, d), "1996-01-01", "1996-12-31", ordered=True)


@query("select_except")
def q_select_except(spark, d):
    return select_except(ml(spark, d, "SalesKey", "DateKey", "SalesAmount", "StoreKey"), "StoreKey")
