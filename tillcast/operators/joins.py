"""Join helpers: left equi-joins with a size-checked broadcast.

A side is broadcast only when its rows, known or counted, are within a bound
(``tillcast.broadcast.maxBytes``, default 64 MiB).  Above the bound nothing
is forced: Spark plans a sort-merge join, and AQE may
still turn it into a broadcast once the real shuffle sizes are known.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
GROWING_BYTES = 4 * 1024 * 1024   # of a dimension that grows with the fact, up to which it is joined as the others


_TYPE_BYTES = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "date": 4, "float": 4,
               "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "decimal": 16}


def row_width(df: DataFrame) -> int:
    """Bytes per row of a hashed broadcast (strings and other variable-width
    values counted as 32 bytes)."""
    return 16 + sum(_TYPE_BYTES.get(f.dataType.typeName(), 32) for f in df.schema.fields)


def bounded_bytes(df: DataFrame, max_rows: int) -> int:
    """Size bound of a frame known to hold at most ``max_rows`` rows."""
    return max_rows * row_width(df)


def broadcast_limit(df: DataFrame) -> int:
    try:
        raw = df.sparkSession.conf.get("tillcast.broadcast.maxBytes", None)
    except Exception:
        raw = None
    return int(raw) if raw else DEFAULT_BROADCAST_BYTES


def checked_broadcast(df: DataFrame, max_rows: int | None = None,
                      max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast only if the frame's size is within the bound.

    ``max_rows`` is a proven row bound (e.g. the row count of the table
    the dimension is derived from by projection / unique-key left joins);
    without one the frame's rows are counted, no further than the limit."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if max_rows is None:
        most = limit // row_width(df)
        max_rows = df.limit(most + 1).count()
    return F.broadcast(df) if bounded_bytes(df, max_rows) <= limit else df


def left_join(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
              broadcast: bool = True, max_rows: int | None = None) -> DataFrame:
    """Left outer equi-join of a fact with a dimension (dim keys unique)."""
    right = checked_broadcast(dim, max_rows) if broadcast else dim
    return fact.join(right, on=on, how="left")



@dataclass(frozen=True)
class DimSpec:
    """One hop of a star: dimension, join key, the columns it adds.

    ``frame`` and ``max_rows`` (a proven row bound for the broadcast check)
    can be functions, called only if the hop is planned.  ``dim_key``: the
    dimension's name of the key if it differs.  ``grows``: the dimension has
    rows in proportion to the fact; beyond GROWING_BYTES both are shuffled,
    so that the work grows as the data does."""
    name: str
    frame: DataFrame | Callable[[], DataFrame]
    key: str
    columns: Sequence[str] = field(default_factory=tuple)
    max_rows: int | Callable[[], int] | None = None
    dim_key: str | None = None
    grows: bool = False

    def projected(self, columns: Sequence[str] | None = None) -> DataFrame:
        frame = self.frame() if callable(self.frame) else self.frame
        wanted = self.columns if columns is None else columns
        key = F.col(self.dim_key or self.key).alias(self.key)
        return frame.select(key, *[c for c in wanted if c != self.key])

    def rows(self) -> int | None:
        return self.max_rows() if callable(self.max_rows) else self.max_rows



def build_star(fact: DataFrame, dims: Sequence[DimSpec], columns: Sequence[str] | None = None,
               computed: dict[str, tuple[Sequence[str], Column]] | None = None) -> DataFrame:
    """The wide table of a fact and its dimensions, from the wanted columns.

    Only the hops that the columns need are planned, directly or through
    the key of a later hop, and of each dimension only the columns that are
    needed: Spark keeps a left join whose columns nobody reads, since it
    can't know that the dimension's key is unique.  ``computed``: further
    columns by name, as (columns that the expression reads, expression).
    Without ``columns`` everything is joined."""
    computed = computed or {}
    if columns is None:
        columns = [*fact.columns, *[c for d in dims for c in d.columns if c not in fact.columns], *computed]
        columns = list(dict.fromkeys(columns))
    needed = set(columns)
    for name, (reads, _) in reversed(computed.items()):
        if name in needed:
            needed |= set(reads)
    hops: list[tuple[DimSpec, list[str]]] = []
    for d in reversed(dims):
        own = [c for c in d.columns if c in needed and c not in fact.columns]
        if own:
            hops.append((d, own))
            needed.add(d.key)
    out = fact.select(*[c for c in fact.columns if c in needed])
    for d, own in reversed(hops):
        right, most = d.projected(own), d.rows()
        if d.grows and most is not None and bounded_bytes(right, most) > GROWING_BYTES:
            out = left_join(out, right.hint("merge"), d.key, broadcast=False)
        else:
            out = left_join(out, right, d.key, max_rows=most)
    for name, (_, expr) in computed.items():
        if name in needed:
            out = out.withColumn(name, expr)
    missing = [c for c in columns if c not in out.columns]
    if missing:
        raise ValueError(f"no hop of the star has {missing}")
    return out.select(*columns)
