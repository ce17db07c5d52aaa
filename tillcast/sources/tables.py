"""Scans and range reads."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


SPREAD_BYTES = 1 << 20     # of a table from which a small input is spread


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Iterable[str] | None = None,
               min_partitions: int | None = None) -> DataFrame:
    """Parquet scan; a column subset is pruned into the scan's ReadSchema.

    A file of one row group is read by one task however it is split.
    ``min_partitions`` (else the session's ``tillcast.scan.minPartitions``,
    off by default) deals the rows of such small tables out to more tasks; on
    a cluster, where a table has more row groups than cores, leave it off."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    wanted = min_partitions or int(spark.conf.get("tillcast.scan.minPartitions", "0"))
    if wanted > 1 and table_version(spark, path)[0] >= SPREAD_BYTES:
        df = df.repartition(wanted)
    return df.select(*columns) if columns else df


def table_version(spark: SparkSession, path: str) -> tuple[int, int, int]:
    """Bytes, files and modification time of a table: changes when rows are
    appended or replaced."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    total = fs.getContentSummary(p)
    return total.getLength(), total.getFileCount(), fs.getFileStatus(p).getModificationTime()


def data_version(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> str:
    """One string for the state of several tables (part of cache keys)."""
    return "-".join(str(table_version(spark, f"{sf_dir.rstrip('/')}/{n}.parquet")) for n in names)


_ROWS: dict[tuple, int] = {}


def counted_rows(spark: SparkSession, sf_dir: str, name: str, what: str = "",
                 frame: DataFrame | None = None) -> int:
    """Rows of a table, or of a ``frame`` called ``what`` that is derived from
    it, counted once for each state of the table's files."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (path, table_version(spark, path), what)
    if key not in _ROWS:
        _ROWS[key] = (spark.read.parquet(path) if frame is None else frame).count()
    return _ROWS[key]


def scan_csv(spark: SparkSession, path: str, schema: StructType | str,
             header: bool = True) -> DataFrame:
    """Header CSV scan with a declared schema (no inference)."""
    return spark.read.schema(schema).option("header", header).csv(path)



def date_range(df: DataFrame, min_date: str | None, max_date: str | None,
               date_col: str = "DateKey") -> DataFrame:
    """Inclusive ``min <= date <= max`` on a DATE column (either bound may be
    None).  Written as a plain comparison so it reaches the Parquet scan."""
    c = F.col(date_col)
    cond = None
    if min_date is not None:
        cond = c >= F.to_date(F.lit(min_date))
    if max_date is not None:
        hi = c <= F.to_date(F.lit(max_date))
        cond = hi if cond is None else cond & hi
    return df if cond is None else df.where(cond)


def read_range(df: DataFrame, min_date: str, max_date: str, date_col: str = "DateKey",
               ordered: bool = False) -> DataFrame:
    """``SELECT * FROM t WHERE d BETWEEN a AND b [ORDER BY d]``."""
    out = date_range(df, min_date, max_date, date_col)
    return out.orderBy(date_col) if ordered else out


def select_except(df: DataFrame, *columns: str) -> DataFrame:
    """``SELECT * EXCEPT (c, ...)``; absent columns are ignored."""
    return df.drop(*columns)
