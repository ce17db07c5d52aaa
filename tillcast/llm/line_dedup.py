"""Line dedup over levelled sorted runs of line hashes.

Documents are taken in batches from the largest ids down.  A batch's line
keys (128-bit hashes with the number of rows that hold them) are
merge-anti-joined with the runs: keys that no run has are the batch's own
new run, owned by the largest id that holds them; for the others the batch
only adds to their counts.  Runs are sorted by key and lie in levels: when
a level has ``fanout`` runs they are merged into one run of the next, so
that a batch meets few runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import SPACE, delete, numbered, pick, place, ready, scratch

MIN_CHARS = 40
MIN_DOCS = 5
BATCHES = 4
FANOUT = 2


def key_hash(line: str, min_chars: int) -> bytes | None:
    """128 bits of a line's key: white space stripped, A-Z in lower case.  None
    if the key is too short."""
    key = line.strip(SPACE)
    return xxhash.xxh3_128_digest(key.encode().lower()) if len(key) >= min_chars else None


class LineRuns:
    """Levelled runs of (key, docs, top) below one folder, and the counts that
    later batches add to keys that a run already has."""

    def __init__(self, spark, folder: str, fanout: int = FANOUT) -> None:
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = []
        self.more: list[str] = []
        self.written = 0

    def _put(self, df: DataFrame, what: str) -> str:
        self.written += 1
        path = f"{self.folder}/{what}-{self.written}"
        df.write.option("compression", "zstd").parquet(path)
        return path

    def _get(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("key binary, docs long, top long").parquet(*paths)

    def runs(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def add(self, lines: DataFrame) -> None:
        """A batch of (doc_id, key), each key once a row of documents."""
        own = lines.groupBy("key").agg(F.count("*").alias("docs"), F.max("doc_id").alias("top"))
        if self.runs():
            own = self._get([self._put(own, "batch")])
            known = self._get(self.runs()).select("key").hint("merge")
            self.more.append(self._put(own.join(known, "key", "left_semi"), "more"))
            own = own.join(known, "key", "left_anti")
        self._push(0, own.sortWithinPartitions("key"))

    def _push(self, level: int, run: DataFrame) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(self._put(run, f"level{level}"))
        if len(self.levels[level]) == self.fanout:
            old, self.levels[level] = self.levels[level], []
            merged = self._get(old).repartition("key").sortWithinPartitions("key")
            self._push(level + 1, merged)
            for path in old:   # the merged run is written: nothing reads these again
                delete(self.spark, path)

    def totals(self) -> DataFrame:
        """(key, docs, top) over all batches."""
        if not self.runs():
            return self.spark.createDataFrame([], "key binary, docs long, top long")
        return (self._get(self.runs() + self.more).groupBy("key")
                .agg(F.sum("docs").alias("docs"), F.max("top").alias("top")))


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows: list[int] = []
            keys: list[bytes] = []
            for i, t in enumerate(texts):
                own = {k for line in (t.as_py() or "").split("\n") if (k := key_hash(line, min_chars)) is not None}
                keys.extend(own)
                rows.extend([i] * len(own))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows, pa.int64())), pa.array(keys, pa.binary())], names=["doc_id", "key"])
    return run


def _cut(min_chars: int, text_at: int):
    """The last column has the keys that the row loses, or null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: list[str] = []
            count: list[int] = []
            lost: list[int] = []
            for t, gone in zip(batch.column(text_at), batch.column(batch.num_columns - 1), strict=True):
                lines = (t.as_py() or "").split("\n")
                drop = set(gone.as_py() or ())
                stay = [x for x in lines if key_hash(x, min_chars) not in drop] if drop else lines
                kept.append("\n".join(stay))
                count.append(len(lines))
                lost.append(len(lines) - len(stay))
            cols = batch.columns[:-1]
            cols[text_at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(count, pa.int64()), pa.array(lost, pa.int64())],
                                             names=[*batch.schema.names[:-1], "n_lines", "n_dropped"])
    return run


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               min_docs: int = MIN_DOCS, batches: int = BATCHES, fanout: int = FANOUT, counts: bool = False) -> DataFrame:
    """``docs`` with the repeated lines dropped from their texts; with
    ``counts`` also n_lines (before) and n_dropped, which replace columns of
    these names.

    A key of at least ``min_chars`` code points that at least ``min_docs``
    rows hold loses all its lines except in rows with the largest id that
    holds it.  Null text is one empty line (and comes back empty).  Rows
    that repeat an id count apiece and lose the same lines; a null id is
    below any other, and if all holders of a key have none, all keep it.
    An empty table gives an empty table.
    """
    spark = docs.sparkSession
    ready(spark)
    folder = scratch(spark, "lines")
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    shares = [1 - (i + 1) / batches for i in range(batches - 1)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares or [0.5])).first()[0] or []
    batch = F.lit(0)
    for cut in cuts if shares else []:   # ids below the cut come in a later batch
        batch = batch + F.coalesce(F.col("doc_id") < cut, F.lit(True)).cast("int")
    (rows.mapInArrow(_keys(min_chars), "doc_id long, key binary").withColumn("batch", batch)
     .write.option("compression", "zstd").partitionBy("batch").parquet(f"{folder}/keys"))
    lines = spark.read.schema("doc_id long, key binary, batch int").parquet(f"{folder}/keys")
    runs = LineRuns(spark, folder, fanout)
    for i in range(batches):
        runs.add(lines.filter(F.col("batch") == i).drop("batch"))
    hot = runs.totals().filter((F.col("docs") >= min_docs) & F.col("top").isNotNull()).select("key", "top")
    hot = spark.read.schema("key binary, docs long, top long").parquet(runs._put(hot, "hot")).drop("docs")
    gone = (lines.join(hot, "key").filter("doc_id IS NULL OR doc_id < top")
            .groupBy(F.col("doc_id").alias("gone_id")).agg(F.collect_set("key").alias("gone")))
    flat, at = numbered(docs), place(docs, text_col)
    ident = F.col(f"c{place(docs, id_col)}").cast("long")
    flat = flat.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in flat.schema.fields)
    out = (flat.join(gone, ident.eqNullSafe(F.col("gone_id")), "left").drop("gone_id")
           .mapInArrow(_cut(min_chars, at), f"{fields}, n_lines long, n_dropped long"))
    new = ["n_lines", "n_dropped"] if counts else []
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in new], *new)
