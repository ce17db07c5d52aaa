"""Model beats the mean baseline where signal exists; copula constraints."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.operators import model as mdl
from tillcast.operators import synth as syn
from tillcast.operators.metrics import mean_baseline, metrics


def _signal(spark, n=300):
    rng = np.random.default_rng(2)
    base = dt.date(2000, 1, 1)
    rows = []
    for i in range(n):
        x1, x2 = rng.normal(), rng.normal()
        rows.append((base + dt.timedelta(days=i), float(x1), float(x2),
                     float(3 * x1 - 2 * x2 + 0.1 * rng.normal())))
    return spark.createDataFrame(rows, "DateKey date, x1 double, x2 double, SalesAmount double")


def test_gbt_beats_mean_baseline(spark):
    df = mdl.holdout_split(_signal(spark), 0.3)
    tr, te = df.where("is_train").drop("is_train"), df.where(~F.col("is_train")).drop("is_train")
    res = mdl.train_gbt(tr, "SalesAmount", te, n_trees=15, max_depth=3, patience=5)
    assert 1 <= res.best_iter <= 15 and res.history.count() == 15
    m = metrics(mdl.predict(res.model, te, res.features)).first()
    b = mean_baseline(tr, te).first()
    assert m.mae < b.mae and m.r2 > 0.5


def test_first_trees_are_a_shorter_fit(spark):
    df = _signal(spark, 200)
    long, short = (mdl.train_gbt(df, "SalesAmount", None, n_trees=k, max_depth=3) for k in (7, 4))
    cut = mdl.first_trees(long.model, 4)
    assert cut.getNumTrees == 4
    score = lambda m: [r.prediction for r in mdl.predict(m, df, long.features).orderBy("DateKey").collect()]
    assert score(cut) == score(short.model)
    more = mdl.continue_gbt(short.model, df, 3, long.features, max_depth=3)
    assert more.getNumTrees == 7 and np.allclose(score(more), score(long.model), atol=1e-9)


def test_rounds_grow_until_the_rule_stops(spark, monkeypatch):
    monkeypatch.setattr(mdl, "ROUNDS_FIRST", 4)
    df = mdl.holdout_split(_signal(spark), 0.3)
    tr, te = df.where("is_train").drop("is_train"), df.where(~F.col("is_train")).drop("is_train")
    grown = mdl.train_gbt(tr, "SalesAmount", te, n_trees=20, max_depth=2, patience=3)
    monkeypatch.setattr(mdl, "ROUNDS_FIRST", 20)
    whole = mdl.train_gbt(tr, "SalesAmount", te, n_trees=20, max_depth=2, patience=3)
    assert grown.best_iter == whole.best_iter and grown.model.getNumTrees == whole.best_iter


def test_null_features(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (float("nan"), None)], "a double, b double")
    assert {r.column: r.nulls for r in mdl.null_features(df, ["a", "b"]).collect()} == {"a": 2, "b": 1}
    assert mdl.assemble(df, ["a", "b"]).count() == 3 and mdl.assemble(df, ["a", "b"], nulls="drop").count() == 1
    with pytest.raises(ValueError, match="zero, drop or error"):
        mdl.assemble(df, ["a"], nulls="mean")


def test_early_stop_patience():
    assert mdl._early_stop([5, 4, 3, 3.5, 3.6, 3.7, 3.8, 3.9, 2.0], 5) == 3
    assert mdl._early_stop([5, 4, 3, 2], 5) == 4


def test_cross_validate_folds(spark):
    cv = mdl.cross_validate(_signal(spark), k=5, kind="tree", max_depth=4).collect()
    assert len(cv) == 5 and sum(r.n for r in cv) == 300


def _daily(spark, n=200):
    rng = np.random.default_rng(4)
    triples = [(0.0, 0.0, 0.0), (10.0, 0.05, 2.0), (20.0, 0.1, 4.0)]
    base = dt.date(2001, 1, 1)
    rows = []
    for i in range(n):
        d = base + dt.timedelta(days=i)
        wd = 1.0 if d.isoweekday() <= 5 else 0.0
        t = triples[int(rng.integers(0, 3))]
        amount = float(round(1000 + 200 * wd + rng.normal(0, 50), 2))
        rows.append((d, amount, float(rng.integers(1, 50)), 1.0 - wd, wd, *t,
                     float(np.sin(2 * np.pi * d.month / 12))))
    return spark.createDataFrame(rows, "DateKey date, SalesAmount double, SalesQuantity double, "
                                       "IsWorkDay_WeekEnd double, IsWorkDay_WorkDay double, "
                                       "DiscountAmount double, DiscountPercent double, "
                                       "DiscountQuantity double, sin_MonthNumber double")


def test_copula_constraints_and_determinism(spark):
    daily = _daily(spark)
    group = ["DiscountAmount", "DiscountPercent", "DiscountQuantity"]
    cols = ["SalesAmount", "SalesQuantity", "IsWorkDay_WeekEnd", "IsWorkDay_WorkDay",
            "sin_MonthNumber"]
    model = syn.fit_copula(daily, cols, groups=[group],
                           onehot=[["IsWorkDay_WeekEnd", "IsWorkDay_WorkDay"]])
    s = syn.sample_copula(spark, model, rows=300, seed=9)
    pdf = s.toPandas()
    observed = {tuple(r) for r in daily.select(*group).distinct().collect()}
    assert {tuple(r) for r in pdf[group].itertuples(index=False)} <= observed
    assert ((pdf.IsWorkDay_WeekEnd + pdf.IsWorkDay_WorkDay) == 1).all()
    lo, hi = daily.agg(F.min("SalesAmount"), F.max("SalesAmount")).first()
    assert pdf.SalesAmount.between(lo, hi).all()
    assert (pdf.SalesQuantity == pdf.SalesQuantity.round(0)).all()
    again = syn.sample_copula(spark, model, rows=300, seed=9, partitions=3).toPandas()
    assert pdf.sort_values("sample_id").SalesAmount.tolist() == \
        again.sort_values("sample_id").SalesAmount.tolist()
    # workday days should draw larger amounts than weekend days (dependence kept)
    wd = pdf[pdf.IsWorkDay_WorkDay == 1].SalesAmount.mean()
    we = pdf[pdf.IsWorkDay_WeekEnd == 1].SalesAmount.mean()
    assert wd > we


def test_conditional_sampling_uses_facts(spark):
    from tillcast.functions.calendar import create_facts, date_spine
    daily = _daily(spark)
    cols = ["SalesAmount", "IsWorkDay_WeekEnd", "IsWorkDay_WorkDay", "sin_MonthNumber"]
    model = syn.fit_copula(daily, cols)
    facts = create_facts(date_spine(spark, "2001-08-01", "2001-09-30"))
    out = syn.sample_with_facts(model, facts, "DateKey").toPandas()
    assert len(out) == 61
    assert out[out.IsWorkDay_WorkDay == 1].SalesAmount.mean() > \
        out[out.IsWorkDay_WeekEnd == 1].SalesAmount.mean()


def test_hashed_normals_moments():
    z = syn.hashed_normals(np.arange(20000), 3, 1)
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03
    assert abs(np.corrcoef(z[:, 0], z[:, 1])[0, 1]) < 0.03


def test_norm_ppf_cdf_roundtrip():
    u = np.linspace(0.001, 0.999, 50)
    np.testing.assert_allclose(syn.norm_cdf(syn.norm_ppf(u)), u, atol=1e-6)


def test_any_number_of_combinations(spark):
    df = spark.range(120_000).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2).cast("double").alias("b"),
                                     (F.col("id") % 10).cast("double").alias("x"))
    model = syn.fit_copula(df, ["x"], groups=[["a", "b"]])
    assert model.numbered[0].count() == 120_000
    drawn = syn.sample_copula(spark, model, rows=1000, seed=3)
    assert drawn.where("b <> 2 * a OR a IS NULL").count() == 0 and drawn.count() == 1000


def test_unfitted_combination_fails(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (1.0, 2.0, 6.0), (3.0, 4.0, 7.0)], "a double, b double, x double")
    model = syn.fit_copula(df, ["x"], groups=[["a", "b"]])
    with pytest.raises(Exception, match="that was not fitted"):
        syn.with_group_scores(df.withColumn("b", F.lit(9.0)), model).collect()
    mid = sorted(r["__grp0"] for r in syn.with_group_scores(df, model).collect())
    np.testing.assert_allclose(mid, [1 / 3, 1 / 3, 5 / 6])


def test_missing_features(spark):
    df = _signal(spark).withColumn("BrandName_A", F.lit(1.0))
    res = mdl.train_gbt(df, "SalesAmount", None, n_trees=2, max_depth=2)
    mdl.predict(res.model, df.drop("BrandName_A"), res.features).collect()
    with pytest.raises(ValueError, match="x2"):
        mdl.predict(res.model, df.drop("x2"), res.features)


def test_train_guard_and_load_newest(spark, tmp_path):
    from tillcast.plans import pipelines as pl
    df = _signal(spark, 60)
    root = str(tmp_path)
    assert pl.pipeline_train(df.limit(9), model_root=root) is None
    assert pl.train_or_load(df.limit(9), root, n_trees=2, max_depth=2) is None
    first = pl.train_or_load(df, root, n_trees=2, max_depth=2)
    again = pl.train_or_load(df.limit(9), root)   # too few rows to train: it was loaded
    assert again.features == first.features and again.model.getNumTrees == first.model.getNumTrees
    new = pl.train_or_load(df, root, forcenew=True, n_trees=3, max_depth=2)
    assert new.model.getNumTrees <= 3 and len(list(tmp_path.glob("2*"))) == 2


def test_val_mae_is_the_saved_rounds(spark):
    from tillcast.plans import pipelines as pl
    out = pl.pipeline_train(_signal(spark, 120), 0.3, n_trees=12, max_depth=3)
    kept = {r.iteration: r.val_mae for r in out.gbt.history.collect()}
    assert out.val_mae == kept[out.gbt.best_iter]


def test_folds_cut_between_days(spark):
    df = _signal(spark, 50).crossJoin(spark.range(7))
    folded = mdl.date_folds(df, 5)
    assert folded.groupBy("DateKey").agg(F.countDistinct("fold").alias("n")).where("n > 1").count() == 0
    assert sorted(r["count"] for r in folded.groupBy("fold").count().collect()) == [70] * 5
    cut = mdl.cut_date_at(df, 0.7)
    assert mdl.cut_date_split(df, cut).where("is_train").count() == 245


def test_curve_and_forest_fit_the_sales_rows(spark, monkeypatch):
    from tillcast.plans import catalog
    got = []
    for name in ("learning_curve", "cross_validate"):
        monkeypatch.setattr(mdl, name, lambda df, **kw: got.append((df, kw["kind"])))
    d = "/root/testdata/sf0.001"
    catalog.q_learning_curve(spark, d)
    catalog.q_train_forest(spark, d)
    assert [kind for _, kind in got] == ["tree", "forest"]
    for df, _ in got:
        assert df.count() > 2 * df.select("DateKey").distinct().count()
