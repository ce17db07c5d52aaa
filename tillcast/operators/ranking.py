"""Global ranks without pulling all rows into one task.

``global_row_number`` numbers rows 1..n in a total order.  Inputs with a
counted row bound that is small use a plain window; all others use two
levels: range-partition and sort on the order key, number rows inside
each partition, checkpoint that (so the numbering is pinned), then add
the running count of all earlier partitions (one row per partition).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.operators.joins import bounded_bytes, broadcast_limit
from tillcast.session import ensure_checkpoint_dir

_LOW_BITS = (1 << 33) - 1


def _orders(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_row_number(df: DataFrame, order: Sequence[str | Column], out: str = "rn",
                      force_distributed: bool = False, max_rows: int | None = None) -> DataFrame:
    """Append ``out`` = 1-based position of each row in ``order``.

    ``order`` must be a total order (add a unique tie-break) for the
    result to be deterministic.  ``max_rows``: a known row bound; the
    single-window plan is used only if one is given and it is small.
    """
    ords = _orders(order)
    if not force_distributed and max_rows is not None and bounded_bytes(df, max_rows) <= broadcast_limit(df):
        return df.withColumn(out, F.row_number().over(Window.orderBy(*ords)))

    local = numbered_ranges(df, ords)
    counts = local.groupBy("_pid").agg(F.max("_lr").alias("_n"))
    # One row per partition: bounded by the partition count.
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(out, F.col("_off") + F.col("_lr"))
            .drop("_pid", "_lr", "_off"))


def numbered_ranges(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in sorted ranges: ``_pid`` (ranges in order) and ``_lr`` (1, 2, ...
    inside a range), checkpointed so that the numbering is pinned."""
    ensure_checkpoint_dir(df.sparkSession)
    ords = _orders(order)
    ranged = (df.repartitionByRange(*ords).sortWithinPartitions(*ords)
              .withColumn("_mid", F.monotonically_increasing_id()))
    return (ranged.withColumn("_pid", F.shiftright("_mid", 33))
            .withColumn("_lr", F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)) + 1)
            .drop("_mid").checkpoint(eager=True))


def lag_rows(df: DataFrame, y: str, order: Sequence[str | Column], out: str = "y_pred") -> DataFrame:
    """Value of the row before in a total order (the first row is dropped): a
    lag inside each sorted range, and the last value of the range before for
    a range's first row."""
    local = numbered_ranges(df, order)
    last = local.groupBy("_pid").agg(F.max_by(F.col(y), F.col("_lr")).alias("_last"))
    # one row for each range: bounded by the partition count
    before = last.select("_pid", F.lag("_last").over(Window.orderBy("_pid")).alias("_before"))
    inside = F.lag(y).over(Window.partitionBy("_pid").orderBy("_lr"))
    joined = local.withColumn("_inside", inside).join(F.broadcast(before), "_pid")
    first = F.col("_lr") == 1
    return (joined.withColumn(out, F.when(first, F.col("_before")).otherwise(F.col("_inside")))
            .where(~first | F.col("_before").isNotNull()).drop("_pid", "_lr", "_inside", "_before"))


def dense_code(df: DataFrame, col: str, out: str = "code", start: int = 1,
               max_rows: int | None = None) -> DataFrame:
    """Distinct non-null values of ``col`` with consecutive codes in sorted
    order (``start``, ``start+1``, ...): a dense rank over the value set.

    ``max_rows``: a counted bound of the distinct values; without one the
    two-level rank is used."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    ranked = global_row_number(values, [col], out="_rn", max_rows=max_rows)
    return ranked.select(col, (F.col("_rn") + F.lit(start - 1)).cast("int").alias(out))


def every_nth(df: DataFrame, order: Sequence[str | Column], n: int,
              rn: str = "rn") -> DataFrame:
    """Keep rows 1, n+1, 2n+1, ... of the total order (display thinning)."""
    ranked = global_row_number(df, order, out=rn)
    return ranked.where((F.col(rn) - 1) % n == 0)



SMALL_PAIRS = 1_000_000     # (k, v) pairs up to which a group's running sums are one window


def cumulative_sums(counts: DataFrame, weights: Sequence[str]) -> DataFrame:
    """Running sums of several non-negative integer weights over distinct
    ``(k, v)`` ordered by ``v`` within ``k``: adds ``<w>_cum`` per weight.

    The pairs are checkpointed and counted.  A few make one window for each
    ``k``; more are range-partitioned, summed inside each range, and the sums
    of the ranges before are added, so that no task holds a whole ``k``."""
    weights = list(weights)
    ensure_checkpoint_dir(counts.sparkSession)
    pairs = counts.select("k", "v", *[F.col(w).cast("long").alias(w) for w in weights]).checkpoint(eager=True)
    if pairs.count() <= SMALL_PAIRS:
        upto = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        return pairs.withColumns({f"{w}_cum": F.sum(w).over(upto) for w in weights})
    ranged = (pairs.repartitionByRange("k", "v").select(F.spark_partition_id().alias("pid"), "k", "v", *weights)
              .checkpoint(eager=True))
    inside = Window.partitionBy("pid", "k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"{w}_cum": F.sum(w).over(inside) for w in weights})
    totals = ranged.groupBy("pid", "k").agg(*[F.sum(w).alias(f"{w}_t") for w in weights])
    before = Window.partitionBy("k").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("pid", "k", *[F.coalesce(F.sum(f"{w}_t").over(before), F.lit(0))
                                          .alias(f"{w}_off") for w in weights])
    out = local.join(offsets, ["pid", "k"])
    return out.select("k", "v", *weights, *[(F.col(f"{w}_off") + F.col(f"{w}_cum"))
                                            .alias(f"{w}_cum") for w in weights])


def cumulative_positions(counts: DataFrame) -> DataFrame:
    """Rank intervals of weighted sorted values.

    Input: distinct ``(k, v)`` with a positive count ``w``.  Output adds
    ``r0``/``r1``: the 1-based first and last position that ``v`` occupies
    in the sorted multiset of its group ``k`` (see ``cumulative_sums``)."""
    cum = cumulative_sums(counts.select("k", "v", "w"), ["w"])
    return cum.select("k", "v", "w", (F.col("w_cum") - F.col("w") + 1).alias("r0"),
                      F.col("w_cum").alias("r1"))
