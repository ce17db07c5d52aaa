"""Writers, the read-through cache, the run/model registry, and the
fit -> transform property of the feature chain."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from tillcast.operators import registry as reg
from tillcast.sources import sinks
from tillcast.sources.tables import scan_csv


def _daily(spark):
    base = dt.date(2001, 1, 1)
    return spark.createDataFrame([(base + dt.timedelta(days=i), float(i) * 1.5) for i in range(40)],
                                 "DateKey date, SalesAmount double")


def test_csv_and_table_roundtrip(spark):
    root = tempfile.mkdtemp(prefix="tillcast-sink-")
    df = _daily(spark)
    sinks.write_csv(df, root + "/csv")
    back = scan_csv(spark, root + "/csv", "DateKey date, SalesAmount double")
    assert sorted(back.collect()) == sorted(df.collect())
    sinks.write_table(df.withColumn("m", F.month("DateKey")), root + "/t", partition_by=["m"])
    sinks.write_table(df.withColumn("m", F.month("DateKey")), root + "/t", truncate=False,
                      partition_by=["m"])
    t = spark.read.parquet(root + "/t")
    assert t.count() == 80 and t.where("m = 2").count() == 18


def test_materialize_reads_through(spark):
    root = tempfile.mkdtemp(prefix="tillcast-cache-")
    calls = []

    def compute():
        calls.append(1)
        return _daily(spark)
    a = sinks.materialize(spark, "k1", compute, root=root)
    b = sinks.materialize(spark, "k1", compute, root=root)
    assert len(calls) == 1 and a.count() == b.count() == 40
    f = sinks.materialize_filtered(spark, "k1", compute, "2001-01-10", "2001-01-19", root=root)
    assert f.count() == 10 and len(calls) == 1


def test_runs_and_models(spark):
    from pyspark.ml.regression import LinearRegression, LinearRegressionModel
    from pyspark.ml.feature import VectorAssembler
    root = tempfile.mkdtemp(prefix="tillcast-reg-")
    reg.save_run(spark, root + "/runs", "train", 0.5, 100, 1.0)
    reg.save_run(spark, root + "/runs", "evaluate", 0.5, 50, 2.0)
    runs = reg.read_runs(spark, root + "/runs")
    assert reg.latest_by_time(runs).first().context == "evaluate"
    assert reg.latest_by_name(runs, "train").first().mae == 1.0
    assert reg.load_latest(spark, root + "/models", LinearRegressionModel) is None
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, label double"))
    m = LinearRegression().fit(df)
    reg.save_model(m, root + "/models")
    again = reg.load_latest(spark, root + "/models", LinearRegressionModel)
    assert abs(again.coefficients[0] - 2.0) < 1e-6


def test_counts_follow_the_table(spark, tmp_path):
    from tillcast.sources.tables import counted_rows, data_version
    path = f"{tmp_path}/t.parquet"
    spark.range(5).write.parquet(path)
    before = data_version(spark, str(tmp_path), ["t"])
    assert counted_rows(spark, str(tmp_path), "t") == 5
    spark.range(3).write.mode("append").parquet(path)
    assert counted_rows(spark, str(tmp_path), "t") == 8
    assert data_version(spark, str(tmp_path), ["t"]) != before


def test_fit_transform_shape_is_stable(spark):
    from tests.conftest import SF001
    from tillcast.operators import features as fea
    from tillcast.plans.star import denorm_ml
    star = denorm_ml(spark, SF001)
    model = fea.fit_features(star)
    a = fea.transform_features(star, model)
    b = fea.transform_features(star.where(F.col("CalendarYear") == 1996), model)
    assert a.columns == b.columns  # fitted categories fix the width
    assert a.count() == star.count()
