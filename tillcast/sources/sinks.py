"""Writers and the read-through result cache.

Paths are ordinary Spark paths (any Hadoop-compatible store).  Default
locations live under the shared folder the session names in
``spark.checkpoint.dir`` (or ``tillcast.warehouse.dir`` when set).
"""

from __future__ import annotations

import hashlib
import re
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tillcast.session import ensure_checkpoint_dir
from tillcast.sources.tables import date_range


def warehouse_dir(spark: SparkSession) -> str:
    conf = spark.conf.get("tillcast.warehouse.dir", None)
    if conf:
        return conf.rstrip("/")
    return ensure_checkpoint_dir(spark).rstrip("/") + "/tillcast-warehouse"


def _fs_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, replacing what is there (directories created)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, truncate: bool = True,
                partition_by: list[str] | None = None) -> None:
    """Truncate-or-append load as Parquet (optionally partitioned, e.g. by
    year, so date filters prune files)."""
    w = df.write.mode("overwrite" if truncate else "append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_clustered(df: DataFrame, path: str, date_col: str = "DateKey",
                    partition_col: str = "year", files: int | None = None) -> None:
    """Date-clustered Parquet: range-partition on the date (balanced by
    sampling, so no task holds a whole year), sort inside each task, and
    lay directories out by year.  Date ranges then prune directories
    (PartitionFilters) and row groups (min/max statistics).  Without
    ``files`` adaptive execution sizes the tasks by the bytes they get."""
    from pyspark.sql import functions as F

    out = df.withColumn(partition_col, F.year(date_col)) if partition_col not in df.columns \
        else df
    ranged = out.repartitionByRange(files, date_col) if files else out.repartitionByRange(date_col)
    (ranged.sortWithinPartitions(date_col)
     .write.mode("overwrite").partitionBy(partition_col).parquet(path))


def read_clustered(spark: SparkSession, path: str, min_date: str | None, max_date: str | None,
                   date_col: str = "DateKey", partition_col: str = "year") -> DataFrame:
    """Range read of a clustered table: the year bounds prune directories,
    the date bounds are pushed to the Parquet reader."""
    from pyspark.sql import functions as F

    df = spark.read.parquet(path)
    if min_date:
        df = df.where(F.col(partition_col) >= int(min_date[:4]))
    if max_date:
        df = df.where(F.col(partition_col) <= int(max_date[:4]))
    return date_range(df, min_date, max_date, date_col).drop(partition_col)


def stored(df: DataFrame, what: str) -> DataFrame:
    """Written below the warehouse and read again: later passes read the rows
    instead of computing them, on any executor."""
    path = f"{warehouse_dir(df.sparkSession)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cache_key(*parts) -> str:
    text = "|".join(str(p) for p in parts)
    slug = re.sub(r"[^A-Za-z0-9_.-]+", "_", text)[:80]
    return f"{slug}-{hashlib.md5(text.encode()).hexdigest()[:12]}"


def materialize(spark: SparkSession, key: str, compute: Callable[[], DataFrame],
                root: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Read-through cache of a query result keyed by its parameters: read
    the stored result when its commit marker exists, otherwise compute,
    write (also when it has a single row) and read back."""
    base = (root or warehouse_dir(spark)).rstrip("/")
    path = f"{base}/{key}"
    if not _fs_exists(spark, f"{path}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(path)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def materialize_filtered(spark: SparkSession, key: str, compute: Callable[[], DataFrame],
                         min_date: str, max_date: str, date_col: str = "DateKey",
                         root: str | None = None) -> DataFrame:
    return date_range(materialize(spark, key, compute, root), min_date, max_date, date_col)
