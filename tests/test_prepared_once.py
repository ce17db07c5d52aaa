"""The preprocess pipeline runs what it joins once: fit and transform read the
same prepared rows."""

from pyspark.sql import functions as F

from tests.conftest import SF001
from tillcast.operators import features as fea
from tillcast.plans import catalog, pipelines as pl
from tillcast.plans.star import denorm_ml


def seen_by(monkeypatch, module, run):
    """Files that the rows come from which ``run`` aggregates."""
    seen, plain = [], module.sea.seasonalize

    def spy(df, *a, **kw):
        seen.extend(df.inputFiles())
        return plain(df, *a, **kw)

    monkeypatch.setattr(module.sea, "seasonalize", spy)
    run()
    return seen


def test_daily_table_reads_prepared_rows(spark, monkeypatch):
    files = seen_by(monkeypatch, pl, lambda: pl.pipeline_preprocess(spark, SF001))
    assert files and not any("lineitem" in f or "orders" in f for f in files)


def test_grains_read_prepared_rows(spark, monkeypatch):
    files = seen_by(monkeypatch, catalog, lambda: catalog.QUERIES["seasonalize_monthly"](spark, SF001))
    assert files and not any("lineitem" in f or "orders" in f for f in files)


def test_fit_transform_is_fit_and_transform(spark):
    star = denorm_ml(spark, SF001).where(F.col("CalendarYear") == 1996)
    model, got = fea.fit_transform(star)
    want = fea.transform_features(star, fea.fit_features(star))
    assert got.columns == want.columns and model.onehot_columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
