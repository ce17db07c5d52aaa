"""What the operators of this folder share: positional column access, the
shared scratch folder and the white space of the contracts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.session import ensure_checkpoint_dir, ship_package

# The characters [\x20\x09-\x0D].  bytes.split() without an
# argument and bytes.strip() use the same six.
SPACE = " \t\n\x0b\x0c\r"
SPACE_BYTES = SPACE.encode()
WORD = r"[^\x20\x09-\x0D]+"


def place(df: DataFrame, name: str) -> int:
    """Position of a column: the exact name, else the first one that differs
    in case only."""
    if name in df.columns:
        return df.columns.index(name)
    low = [c.lower() for c in df.columns]
    if name.lower() not in low:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return low.index(name.lower())


def numbered(df: DataFrame) -> DataFrame:
    """The same columns named c0, c1, ...: names that clash with each other or
    with an operator's own columns do no harm."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """The wanted columns under an operator's own names, e.g. pick(df, doc_id="id")."""
    flat = numbered(df)
    return flat.select([F.col(f"c{place(df, c)}").alias(k) for k, c in wanted.items()])


ARROW_BYTES = 8 << 20   # of an Arrow batch that goes to a Python worker


def ready(spark: SparkSession) -> None:
    """Executors get the package, the session its shared checkpoint folder and
    Arrow batches that keep a worker's memory small for long texts too."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def scratch(spark: SparkSession, what: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage, so that a
    lost executor costs no more than the tasks it had."""
    path = scratch(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote itself."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
