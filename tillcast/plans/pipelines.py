"""End-to-end pipelines: preprocess, train, evaluate, predict, forecast,
synthetic back-test.

Each is one lazy plan per stage plus the small fit jobs of the encoders
and the model.  The cleaned star runs once: its prepared rows are written,
for the fit and for the daily table; the daily table is written once and
read by all that follows.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast import schema as S
from tillcast.functions.calendar import create_facts, date_spine
from tillcast.operators import features as fea
from tillcast.operators import filters as flt
from tillcast.operators import model as mdl
from tillcast.operators import registry as reg
from tillcast.operators import seasonal as sea
from tillcast.operators import synth as syn
from tillcast.operators.metrics import mean_baseline, metrics
from tillcast.plans.star import denorm_ml, fact_measures
from tillcast.sources.sinks import stored, write_table
from tillcast.sources.tables import date_range


@dataclass
class Processed:
    daily: DataFrame            # DateKey, daily features, SalesAmount
    features: fea.FeatureModel  # fitted encoders (reused for new data)
    ratio: float = 1.0          # share of the sales that was read


def daily_features(rows: DataFrame, model: fea.FeatureModel, groups: Sequence[str] = ()) -> DataFrame:
    """Row features (target dropped) aggregated by day, and by the raw values
    of the ``groups`` columns, which become ``group_<column>``."""
    x = rows.drop("SalesAmount").withColumns({f"group_{g}": F.col(g) for g in groups})
    return sea.seasonalize(fea.transform_features(x, model), "daily", extra=[f"group_{g}" for g in groups])


def where_equal(df: DataFrame, filters: dict[str, object] | None) -> DataFrame:
    """Rows whose columns have the given values (a null value: is null)."""
    for key, value in (filters or {}).items():
        df = df.where(F.col(key).eqNullSafe(F.lit(value)))
    return df


def group_spine(spark: SparkSession, days: DataFrame, min_date: str, max_date: str, groups: Sequence[str]) -> DataFrame:
    """Every day of the range, or every day for each group of ``days``."""
    if not groups:
        return date_spine(spark, min_date, max_date)
    every = F.sequence(F.to_date(F.lit(min_date)), F.to_date(F.lit(max_date)))
    return days.select(*groups).distinct().withColumn("DateKey", F.explode(every))


def on_spine(spine: DataFrame, scored: DataFrame, groups: Sequence[str]) -> DataFrame:
    """``scored`` on every day of the spine; null groups meet too."""
    if not groups:
        return spine.join(scored, "DateKey", "left")
    right = scored.select(*[F.col(c).alias(f"_{c}" if c in ("DateKey", *groups) else c) for c in scored.columns])
    same = F.col("DateKey") == F.col("_DateKey")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    return spine.join(right, same, "left").drop("_DateKey", *[f"_{g}" for g in groups])


def pipeline_preprocess(spark: SparkSession, sf_dir: str, min_date: str | None = None,
                        max_date: str | None = None, ratio: float | None = None,
                        out_path: str | None = None, clean: bool = True) -> Processed:
    """Range read -> 2.5 sigma clean -> row features (fit on the cleaned rows)
    -> daily features and daily target -> optional overwrite of the
    processed table."""
    star = denorm_ml(spark, sf_dir, ratio=ratio, min_date=min_date, max_date=max_date)
    stats = fact_measures(spark, sf_dir, ratio=ratio, min_date=min_date, max_date=max_date)
    rows = flt.clean_outliers(star, stats_df=stats) if clean else star
    model, feats = fea.fit_transform(rows, drop=["SalesKey"])
    # the target goes with the features in one aggregate: no join on the date
    daily = sea.seasonalize(feats, "daily")
    daily = daily.select(*[c for c in daily.columns if c != "SalesAmount"], "SalesAmount")
    # one row per day: a calendar-bounded table, kept in few partitions so
    # the small downstream fits (copula, boosting, per-series) run few tasks
    daily = stored(daily.coalesce(spark.sparkContext.defaultParallelism), "daily")
    if out_path:
        write_table(daily, out_path, truncate=True)
    return Processed(daily, model, ratio or 1.0)


@dataclass
class TrainResult:
    gbt: mdl.GbtResult
    val_mae: float
    run_id: str | None
    model_path: str | None


def pipeline_train(processed: DataFrame, split_ratio: float = 0.1, runs_path: str | None = None,
                   model_root: str | None = None, n_trees: int = S.GBT_DEFAULTS["n_trees"],
                   max_depth: int = S.GBT_DEFAULTS["max_depth"], min_rows: int = 10,
                   training_set_size: float = 1.0) -> TrainResult | None:
    """Tail split -> boosted trees with early stopping on the tail -> save
    run and model.  None when fewer than ``min_rows`` rows."""
    if not mdl.train_guard(processed, min_rows):
        return None
    split = mdl.holdout_split(processed, split_ratio).persist()
    train = split.where("is_train").drop("is_train")
    val = split.where(~F.col("is_train")).drop("is_train")
    res = mdl.train_gbt(train, "SalesAmount", val, n_trees=n_trees, max_depth=max_depth)
    kept = res.history.where(F.col("iteration") == res.best_iter).first()   # the round of the saved model
    val_mae = kept["val_mae"]
    run_id = path = None
    if runs_path:
        run_id = reg.save_run(processed.sparkSession, runs_path, "train", training_set_size,
                              train.count(), val_mae, {"n_trees": n_trees, "depth": max_depth,
                                                       "best_iter": res.best_iter})
    if model_root:
        path = reg.save_model(res.model, model_root, res.features)
    split.unpersist()
    return TrainResult(res, val_mae, run_id, path)


@dataclass
class Trained:
    model: mdl.GBTRegressionModel
    features: list[str]


def train_or_load(processed: DataFrame, model_root: str, forcenew: bool = False, **kw) -> Trained | None:
    """The newest saved model; if there is none, or with ``forcenew``, one that
    is trained now (by ``pipeline_train``) and saved.  None when the table
    has too few rows to train on."""
    spark = processed.sparkSession
    if not forcenew and (found := reg.load_latest(spark, model_root, mdl.GBTRegressionModel)) is not None:
        return Trained(found, reg.load_features(spark, model_root))
    done = pipeline_train(processed, model_root=model_root, **kw)
    return None if done is None else Trained(done.gbt.model, done.gbt.features)


def pipeline_evaluate(processed: DataFrame, model, features: list[str], min_date: str,
                      max_date: str, runs_path: str | None = None,
                      training_set_size: float = 1.0) -> DataFrame | None:
    """Score a date range of the processed table; MAE etc. (run saved)."""
    part = date_range(processed, min_date, max_date)
    if part.limit(1).count() == 0:
        return None
    scored = mdl.predict(model, part, features)
    m = metrics(scored, "SalesAmount", "prediction")
    if runs_path:
        row = m.first()
        reg.save_run(processed.sparkSession, runs_path, "evaluate", training_set_size,
                     row["n"], row["mae"])
    return m


def pipeline_predict(spark: SparkSession, sf_dir: str, proc: Processed, model,
                     features: list[str], min_date: str, max_date: str, clean: bool = False,
                     filters: dict[str, object] | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """Features of a date range (fitted encoders reused) -> daily -> score.

    By default all rows of the range are used, as in the original, although
    the model was trained on rows without outliers; ``clean`` drops them
    here too.  ``filters`` keeps the sales with these column values,
    ``groups`` gives a prediction for each day and group of sales."""
    star = where_equal(denorm_ml(spark, sf_dir, min_date=min_date, max_date=max_date), filters)
    if clean:
        star = flt.clean_outliers(star, stats_df=fact_measures(spark, sf_dir, min_date=min_date, max_date=max_date))
    daily = daily_features(star, proc.features, groups)
    scored = mdl.predict(model, daily, features)
    return scored.select("DateKey", *[F.col(f"group_{g}").alias(g) for g in groups], "prediction")


def forecast_past(spark: SparkSession, sf_dir: str, proc: Processed, model, features: list[str],
                  min_date: str, max_date: str, scale: float | None = None,
                  filters: dict[str, object] | None = None, groups: Sequence[str] = ()) -> DataFrame:
    """Score existing days, rescale by 1 / the sampled share (or ``scale``),
    and key every day of the range (a day without sales gets a null, never a
    shifted value); with ``groups``, every day of each group that has sales
    in the range.  ``filters``: see ``pipeline_predict``."""
    pred = pipeline_predict(spark, sf_dir, proc, model, features, min_date, max_date, filters=filters, groups=groups)
    pred = pred.withColumn("prediction", F.col("prediction") * F.lit(1 / proc.ratio if scale is None else float(scale)))
    if groups:
        pred = stored(pred, "predicted")      # read for its groups and its values
    return on_spine(group_spine(spark, pred, min_date, max_date, groups), pred, groups)


def forecast(spark: SparkSession, sf_dir: str, proc: Processed, model, features: list[str],
             copula: syn.CopulaModel, min_date: str, max_date: str, last_actual: str,
             scale: float | None = None, seed: int = 42, filters: dict[str, object] | None = None,
             groups: Sequence[str] = (), share_days: int = 365) -> DataFrame:
    """Days up to ``last_actual`` are scored from actual features, later days
    from synthetic features drawn given their calendar facts; both parts
    are unioned by name and keyed on a calendar spine.

    Synthetic days stand for all sales.  With ``filters`` or ``groups`` their
    prediction is dealt out by the share of revenue that the filtered sales,
    or each group of them, had in the ``share_days`` up to ``last_actual``."""
    spine_of = lambda days: group_spine(spark, days, min_date, max_date, groups)
    factor = 1 / proc.ratio if scale is None else float(scale)
    past_end = min(max_date, last_actual)
    names = ["DateKey", *groups, "prediction", "source"]
    parts = []
    if min_date <= last_actual:
        past = pipeline_predict(spark, sf_dir, proc, model, features, min_date, past_end, filters=filters, groups=groups)
        parts.append(past.withColumn("source", F.lit("actual")).select(*names))
    if max_date > last_actual:
        fut = date_spine(spark, min_date, max_date).where(F.col("DateKey") > F.to_date(F.lit(last_actual)))
        synth = syn.sample_with_facts(copula, create_facts(fut), "DateKey", seed=seed) \
            .withColumn("CalendarYear", F.year("DateKey"))
        scored = mdl.predict(model, synth, features).select("DateKey", "prediction")
        if filters or groups:
            first = (_dt.date.fromisoformat(last_actual) - _dt.timedelta(days=share_days - 1)).isoformat()
            lately = denorm_ml(spark, sf_dir, min_date=first, max_date=last_actual)
            total = lately.agg(sea.money_sum("SalesAmount").alias("_total"))                  # one row
            shares = where_equal(lately, filters).groupBy(*groups).agg(sea.money_sum("SalesAmount").alias("_part"))
            shares = shares.crossJoin(F.broadcast(total)).select(*groups, F.try_divide("_part", "_total").alias("_share"))
            # each group's row gets the synthetic days, of which there are as many as the calendar has
            days = scored.agg(F.collect_list(F.struct("DateKey", F.col("prediction").alias("p"))).alias("_days"))
            scored = shares.crossJoin(F.broadcast(days)).select(*groups, "_share", F.inline("_days"))
            scored = scored.withColumn("prediction", F.col("p") * F.col("_share"))
        parts.append(scored.withColumn("source", F.lit("synthetic")).select(*names))
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    both = both.withColumn("prediction", F.col("prediction") * F.lit(factor))
    if groups:
        both = stored(both, "forecast")
    return on_spine(spine_of(both), both, groups)


FACTS = ["IsWorkDay_WeekEnd", "IsWorkDay_WorkDay", "sin_MonthNumber", "cos_MonthNumber",
         "sin_CalendarDayOfWeekNumber", "cos_CalendarDayOfWeekNumber",
         "sin_CalendarQuarterLabel", "cos_CalendarQuarterLabel"]
DISCOUNT_GROUP = ["DiscountAmount", "DiscountPercent", "DiscountQuantity"]


def fit_synthesizer(daily: DataFrame) -> syn.CopulaModel:
    """Copula over the daily table (keys and the year left out; the
    discount triple as fixed combinations; the workday pair one-hot)."""
    cols = [c for c in mdl.feature_columns(daily, ("DateKey", "CalendarYear"))
            if c not in DISCOUNT_GROUP]
    cols = cols + (["SalesAmount"] if "SalesAmount" in daily.columns and
                   "SalesAmount" not in cols else [])
    return syn.fit_copula(daily, cols, groups=[DISCOUNT_GROUP],
                          onehot=[["IsWorkDay_WeekEnd", "IsWorkDay_WorkDay"]],
                          families=S.MARGINAL_FAMILIES, default_family=S.MARGINAL_DEFAULT)


def synthetic_backtest(spark: SparkSession, sf_dir: str, train_end: str, test_start: str,
                       test_end: str, n_trees: int = S.GBT_DEFAULTS["n_trees"],
                       max_depth: int = S.GBT_DEFAULTS["max_depth"], split_ratio: float = 0.1) -> DataFrame:
    """Train on days up to ``train_end`` (early stopping on their tail); synthesise the test days from their
    calendar facts; score them against the actual daily revenue and
    against the training-mean baseline."""
    proc = pipeline_preprocess(spark, sf_dir, None, train_end, clean=False)
    daily = proc.daily
    split = mdl.holdout_split(daily, split_ratio)
    res = mdl.train_gbt(split.where("is_train").drop("is_train"), "SalesAmount", split.where(~F.col("is_train")).drop("is_train"),
                        n_trees=n_trees, max_depth=max_depth)
    copula = fit_synthesizer(daily)
    spine = date_spine(spark, test_start, test_end)
    synth = syn.sample_with_facts(copula, create_facts(spine), "DateKey") \
        .withColumn("CalendarYear", F.year("DateKey"))
    scored = mdl.predict(res.model, synth.drop("SalesAmount"), res.features)
    actual = sea.seasonalize_y(denorm_ml(spark, sf_dir, min_date=test_start, max_date=test_end),
                               "daily", ordered=False)
    joined = scored.select("DateKey", "prediction").join(actual, "DateKey")
    model_m = metrics(joined, "SalesAmount", "prediction").withColumn("model", F.lit("gbt"))
    base_m = mean_baseline(daily, actual).withColumn("model", F.lit("mean_baseline"))
    return model_m.unionByName(base_m)
