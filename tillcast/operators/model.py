"""Revenue models on Spark ML: splits, boosted trees with early stopping,
tree / forest baselines, cross-validation, learning curves, scoring."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressionModel, GBTRegressor,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tillcast import schema as S
from tillcast.operators.joins import checked_broadcast
from tillcast.operators.metrics import metrics
from tillcast.session import ensure_checkpoint_dir

FEATURES = "features"


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("DateKey", "SalesAmount")
                    ) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in skip]


def assemble(df: DataFrame, cols: Sequence[str], out: str = FEATURES, nulls: str = "zero") -> DataFrame:
    """Vector column from numeric features.  ``nulls``: a null feature is 0
    (``zero``, as the impute step of the chain has it), its row is left out
    (``drop``), or it fails the job (``error``).  ``null_features`` counts
    them."""
    if nulls not in ("zero", "drop", "error"):
        raise ValueError(f"nulls is zero, drop or error, not {nulls!r}")
    df = df.na.fill(0, subset=list(cols)) if nulls == "zero" else df.na.drop(subset=list(cols)) if nulls == "drop" else df
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(df)


def _vectors(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The frame with its vector column; one that has it already is left as it is."""
    return df if FEATURES in df.columns else assemble(df, cols)


def null_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Nulls and nan of each feature: column, nulls."""
    counts = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in cols])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(list(cols))}, {pairs}) AS (column, nulls)")


def holdout_split(df: DataFrame, test_size: float = 0.1, order: str = "DateKey",
                  flag: str = "is_train") -> DataFrame:
    """Unshuffled tail split: the first ``int(n*(1-test_size))`` rows by
    ``order`` are train.  Meant for calendar-aggregated tables (bounded by
    days); for row-level data split on a cut date instead."""
    w = Window.orderBy(order)
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return (df.withColumn("_rn", F.row_number().over(w)).withColumn("_n", n)
            .withColumn(flag, F.col("_rn") <= F.floor(F.col("_n") * F.lit(1.0 - test_size)))
            .drop("_rn", "_n"))


def cut_date_at(df: DataFrame, train_frac: float, date_col: str = "DateKey", counted: bool = False) -> str:
    """The first date by which at least ``train_frac`` of the rows have come:
    rows are counted by day, so any number of rows is split.  ``counted``: the
    rows are counts by day already (``count``)."""
    days = df.groupBy(date_col).agg((F.sum("count") if counted else F.count("*")).alias("count"))
    upto = F.sum("count").over(Window.orderBy(date_col))   # a row for each day
    total = F.sum("count").over(Window.partitionBy())
    cut = days.select(date_col, (upto >= F.lit(train_frac) * total).alias("enough")).where("enough").agg(F.min(date_col)).first()[0]
    return (cut + _dt.timedelta(days=1)).isoformat()


def date_folds(df: DataFrame, k: int = 5, date_col: str = "DateKey", out: str = "fold") -> DataFrame:
    """Contiguous folds of rows in date order, cut between days: a day belongs
    to the fold that its first row falls into.  The days are counted and the
    rows join them, so no task orders the rows."""
    days = df.groupBy(date_col).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("_c").over(Window.partitionBy())
    fold = F.least(F.floor(before * k / total), F.lit(k - 1)).cast("int")
    return df.join(checked_broadcast(days.select(date_col, fold.alias(out))), date_col)


def cut_date_split(df: DataFrame, cut: str, date_col: str = "DateKey",
                   flag: str = "is_train") -> DataFrame:
    return df.withColumn(flag, F.col(date_col) < F.to_date(F.lit(cut)))


def train_guard(df: DataFrame, minimum: int = 10) -> bool:
    """True when ``df`` has at least ``minimum`` rows (reads at most that many)."""
    return df.limit(minimum).count() >= minimum


@dataclass
class GbtResult:
    model: GBTRegressionModel
    best_iter: int
    history: DataFrame
    features: list[str] = field(default_factory=list)


def _early_stop(values: list[float], patience: int) -> int:
    """1-based index of the best round, stopping after ``patience`` rounds
    without improvement."""
    best, best_i, since = float("inf"), 0, 0
    for i, v in enumerate(values):
        if v < best:
            best, best_i, since = v, i, 0
        else:
            since += 1
            if since >= patience:
                break
    return best_i + 1


ROUNDS_FIRST = 16     # rounds that are fitted before the stopping rule is asked
ROWS_PER_TASK = 10_000   # a level of a tree is a job: fewer rows than this aren't worth a task


def _compact(df: DataFrame) -> DataFrame:
    """A persisted frame in no more partitions than its rows are worth."""
    return df.coalesce(df.count() // ROWS_PER_TASK + 1)


def first_trees(model: GBTRegressionModel, k: int) -> GBTRegressionModel:
    """The ensemble of a fitted ensemble's first ``k`` trees: what a fit of ``k``
    rounds gives, since a round depends on those before it only."""
    return _ensemble(model, list(model._java_obj.trees())[:k], list(model.treeWeights)[:k])


def _ensemble(like: GBTRegressionModel, trees: list, weights: list[float]) -> GBTRegressionModel:
    sc = SparkSession.getActiveSession().sparkContext
    gateway, jvm = sc._gateway, sc._jvm
    tree_array = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weight_array = gateway.new_array(jvm.double, len(trees))
    for i, (t, w) in enumerate(zip(trees, weights, strict=True)):
        tree_array[i], weight_array[i] = t, float(w)
    made = jvm.org.apache.spark.ml.regression.GBTRegressionModel(like.uid, tree_array, weight_array, like.numFeatures)
    return GBTRegressionModel(made)


def train_gbt(train: DataFrame, label: str = "SalesAmount", val: DataFrame | None = None,
              features: Sequence[str] | None = None, max_depth: int = S.GBT_DEFAULTS["max_depth"],
              n_trees: int = S.GBT_DEFAULTS["n_trees"],
              learning_rate: float = S.GBT_DEFAULTS["learning_rate"],
              patience: int = S.GBT_DEFAULTS["patience"], seed: int = 42, max_bins: int = 64) -> GbtResult:
    """Boosted trees (absolute-error metric for early stopping).

    Spark's built-in validation stops at the first flat round, so rounds are
    fitted in growing numbers (16, 32, ... up to ``n_trees``) until the
    validation error hasn't fallen for ``patience`` rounds; the model is the
    ensemble cut after its best round.  Rounds are deterministic (no
    subsampling), so this is the model of ``n_trees`` rounds with that rule,
    and no more than about twice the rounds that it looks at are fitted.
    ``max_bins``: candidate splits of a feature.
    """
    spark = train.sparkSession
    cols = list(features) if features else feature_columns(train, ("DateKey", label))
    tr = _vectors(train, cols).select(FEATURES, label).persist()   # read by every round
    va = _vectors(val, cols).select(FEATURES, label).persist() if val is not None else None
    rows, held_out = _compact(tr), _compact(va) if va is not None else None
    k = n_trees if va is None else min(ROUNDS_FIRST, n_trees)
    while True:
        model = GBTRegressor(featuresCol=FEATURES, labelCol=label, maxDepth=max_depth, maxIter=k,
                             stepSize=learning_rate, seed=seed, maxBins=max_bins).fit(rows)
        val_err = model.evaluateEachIteration(held_out, "absolute") if va is not None else [None] * k
        best = _early_stop(val_err, patience) if va is not None else k
        if k == n_trees or best + patience <= k:
            break
        k = min(2 * k, n_trees)
    train_err = model.evaluateEachIteration(rows, "absolute")
    if best < k:
        model = first_trees(model, best)
    for held in (tr, va):
        if held is not None:
            held.unpersist()
    hist = spark.createDataFrame(
        [(i + 1, float(t), (float(v) if v is not None else None))
         for i, (t, v) in enumerate(zip(train_err, val_err))],
        "iteration int, train_mae double, val_mae double")
    return GbtResult(model, best, hist, cols)


def continue_gbt(model: GBTRegressionModel, train: DataFrame, rounds: int, features: Sequence[str],
                 label: str = "SalesAmount", max_depth: int = S.GBT_DEFAULTS["max_depth"],
                 learning_rate: float = S.GBT_DEFAULTS["learning_rate"], seed: int = 42, max_bins: int = 64) -> GBTRegressionModel:
    """Boosting continued from a saved model by ``rounds`` trees, on the same or on
    new rows: each tree fits the squared error's negative gradient at the
    ensemble so far, as a round of the first fit does.  The running
    prediction is checkpointed every ten rounds."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    trees, weights, held = list(model._java_obj.trees()), list(model.treeWeights), []
    now = model.transform(assemble(train, features)).select(FEATURES, F.col(label).cast("double").alias("_y"), F.col("prediction").alias("_f"))
    now = now.checkpoint(eager=True)
    for i in range(rounds):
        step = now.withColumn("_r", 2 * (F.col("_y") - F.col("_f")))
        tree = DecisionTreeRegressor(featuresCol=FEATURES, labelCol="_r", predictionCol="_t", maxDepth=max_depth,
                                     seed=seed + len(trees), maxBins=max_bins).fit(step)
        held.append(tree)      # a wrapper that is dropped lets go of its tree
        trees.append(tree._java_obj)
        weights.append(learning_rate)
        now = tree.transform(now).select(FEATURES, "_y", (F.col("_f") + learning_rate * F.col("_t")).alias("_f"))
        if i % 10 == 9 and i + 1 < rounds:
            now = now.checkpoint(eager=True)
    return _ensemble(model, trees, weights)


def predict(model, df: DataFrame, features: Sequence[str], scale: float = 1.0,
            out: str = "prediction") -> DataFrame:
    """Score rows; ``scale`` multiplies predictions (1 / sample ratio).  A
    one-hot column absent from ``df`` (a category never seen in the scored
    range) is 0 in every row; any other absent feature is an error."""
    missing = [c for c in features if c not in df.columns]
    strange = [c for c in missing if not any(c.startswith(p + "_") for p in S.ONE_HOT_COLUMNS)]
    if strange:
        raise ValueError(f"features missing from the scored rows: {strange}")
    if missing:
        df = df.withColumns({c: F.lit(0.0) for c in missing})
    scored = model.transform(assemble(df, features)).drop(FEATURES)
    if scale != 1.0:
        scored = scored.withColumn(out, F.col(out) * F.lit(float(scale)))
    return scored


def train_tree(train: DataFrame, label: str, features: Sequence[str], max_depth: int = 10,
               seed: int = 42):
    return DecisionTreeRegressor(featuresCol=FEATURES, labelCol=label, maxDepth=max_depth,
                                 seed=seed).fit(_vectors(train, features))


def train_forest(train: DataFrame, label: str, features: Sequence[str], n_trees: int = 10,
                 max_depth: int = 10, seed: int = 42):
    return RandomForestRegressor(featuresCol=FEATURES, labelCol=label, numTrees=n_trees,
                                 maxDepth=max_depth, seed=seed).fit(_vectors(train, features))


def _fit(kind: str, train: DataFrame, label: str, features: Sequence[str], **kw):
    if kind == "tree":
        return train_tree(train, label, features, **kw)
    if kind == "forest":
        return train_forest(train, label, features, **kw)
    if kind == "gbt":
        return train_gbt(train, label, None, features, **kw).model
    raise ValueError(kind)


METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
METHOD_BYTES = 8000   # of bytecode: the JVM never compiles a longer method


def _folded(df: DataFrame, cols: Sequence[str], label: str, k: int) -> DataFrame:
    """Vector, label, day and fold of each row, persisted: the vectors are
    assembled once and read by each pass of each fit and by the scoring.

    The code that Spark makes for a stage over so many columns is one method
    that the JVM only interprets; here such a stage runs operator by operator,
    whose code is split."""
    rows = date_folds(df, k)
    keep = [FEATURES, label, "DateKey", "fold"]
    conf = df.sparkSession.conf
    before = conf.get(METHOD_LIMIT)
    conf.set(METHOD_LIMIT, str(min(int(before), METHOD_BYTES)))   # persist() takes the settings of its time
    try:
        folded = assemble(rows, cols).select(*keep).persist()
        folded.count()
    finally:
        conf.set(METHOD_LIMIT, before)
    return folded


def _scored(model, df: DataFrame, label: str):
    """The metrics of a model on rows that have their vectors."""
    return metrics(model.transform(df).select(label, "prediction"), label, "prediction").first()


def cross_validate(df: DataFrame, label: str = "SalesAmount", features: Sequence[str] | None = None,
                   k: int = 5, kind: str = "tree", **kw) -> DataFrame:
    """R^2 (and MAE) on each of ``k`` contiguous folds."""
    spark = df.sparkSession
    cols = list(features) if features else feature_columns(df, ("DateKey", label))
    folded = _folded(df, cols, label, k)
    rows = []
    for f in range(k):
        model = _fit(kind, folded.where(F.col("fold") != f), label, cols, **kw)
        m = _scored(model, folded.where(F.col("fold") == f), label)
        rows.append((f, m["n"], m["mae"], m["r2"]))
    folded.unpersist()
    return spark.createDataFrame(rows, "fold int, n long, mae double, r2 double")


def learning_curve(df: DataFrame, label: str = "SalesAmount",
                   features: Sequence[str] | None = None, fractions=(0.1, 0.3, 0.5), k: int = 5,
                   kind: str = "tree", **kw) -> DataFrame:
    """Validation R^2 when training on the first fraction of each training
    split (whole days, per fold)."""
    spark = df.sparkSession
    cols = list(features) if features else feature_columns(df, ("DateKey", label))
    folded = _folded(df, cols, label, k)
    days = folded.groupBy("fold", "DateKey").count().persist()   # a row for each day
    rows = []
    for frac in fractions:
        for f in range(k):
            tr = folded.where(F.col("fold") != f)
            cut = cut_date_at(days.where(F.col("fold") != f), frac, counted=True)
            part = cut_date_split(tr, cut, flag="_in").where("_in").drop("_in")
            model = _fit(kind, part, label, cols, **kw)
            m = _scored(model, folded.where(F.col("fold") == f), label)
            rows.append((float(frac), f, m["r2"]))
    days.unpersist()
    folded.unpersist()
    return spark.createDataFrame(rows, "fraction double, fold int, r2 double")
