"""Run and model registry on plain Spark paths.

Runs are rows appended to a Parquet table; models are Spark ML
directories named by a UTC timestamp, the newest one wins.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUNS_SCHEMA = ("run_id string, ts timestamp, context string, training_set_size double, "
               "row_count long, mae double, params string")


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def save_run(spark: SparkSession, runs_path: str, context: str, training_set_size: float,
             row_count: int, mae: float | None, params: dict | None = None) -> str:
    run_id = uuid.uuid4().hex
    row = [(run_id, _now(), context, float(training_set_size), int(row_count),
            None if mae is None else float(mae), json.dumps(params or {}, sort_keys=True))]
    spark.createDataFrame(row, RUNS_SCHEMA).write.mode("append").parquet(runs_path)
    return run_id



def read_runs(spark: SparkSession, runs_path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(runs_path)


def latest_by_time(runs: DataFrame) -> DataFrame:
    """The newest run (ties on the timestamp broken by run id)."""
    return runs.agg(F.max_by(F.struct(*runs.columns), F.struct("ts", "run_id")).alias("r")) \
        .select("r.*")


def latest_by_name(runs: DataFrame, context: str) -> DataFrame:
    return latest_by_time(runs.where(F.col("context") == context))


def save_model(model, root: str, features: list[str] | None = None) -> str:
    """Below a new folder named by the time; with its feature columns in order."""
    stamp = _now().strftime("%Y%m%d-%H%M%S-%f")
    path = f"{root.rstrip('/')}/{stamp}"
    if features is not None:   # before the model: a folder with a model is complete
        spark = SparkSession.getActiveSession()
        spark.createDataFrame(list(enumerate(features)), "position int, name string").coalesce(1).write.parquet(f"{root.rstrip('/')}/_features/{stamp}")
    model.write().overwrite().save(path)
    return path


def load_features(spark: SparkSession, root: str) -> list[str]:
    """Feature columns of the newest model under ``root``."""
    newest = _models(spark, root)[-1]
    rows = spark.read.parquet(f"{root.rstrip('/')}/_features/{newest}").collect()
    return [r["name"] for r in sorted(rows, key=lambda r: r["position"])]


def _models(spark: SparkSession, root: str) -> list[str]:
    return [n for n in _list_dirs(spark, root) if not n.startswith("_")]


def _list_dirs(spark: SparkSession, root: str) -> list[str]:
    """Child directory names of ``root`` through the Hadoop FileSystem (works
    for any Spark-supported store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def load_latest(spark: SparkSession, root: str, model_cls):
    """Newest model under ``root`` or None."""
    names = _models(spark, root)
    if not names:
        return None
    return model_cls.load(f"{root.rstrip('/')}/{names[-1]}")
