"""Deterministic row sampling.

A row is kept when the first 8 hex digits of ``md5(key | seed)`` fall
below ``ratio * 16**8``.  The decision depends only on the row's own key,
so it is the same on every engine, every partitioning and every retry,
and it needs no shuffle.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_threshold(ratio: float) -> str:
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("ratio must be within [0, 1]")
    return format(min(int(ratio * 16 ** 8), 16 ** 8 - 1), "08x") if ratio < 1 else "g"


def sample_predicate(key_cols: Sequence[str | Column], ratio: float, seed: int = 42) -> Column:
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in key_cols]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))
    return F.substring(digest, 1, 8) < F.lit(sample_threshold(ratio))


def sample_rows(df: DataFrame, ratio: float, key_cols: Sequence[str | Column],
                seed: int = 42) -> DataFrame:
    """Keep about ``ratio`` of the rows, chosen by key hash (no replacement)."""
    return df.where(sample_predicate(key_cols, ratio, seed))
