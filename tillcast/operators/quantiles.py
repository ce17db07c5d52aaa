"""Exact quantiles (linear interpolation, as ``quantile_cont``) by selection.

One aggregate over the rows builds a mergeable sketch of each column, which
brackets each wanted rank between two values close to it.  A second aggregate
counts the values below, at and between the two, and brings the few between
them.  The counts decide where the rank lies, so the result is exact whatever
the sketch says; a bracket that is still too wide is narrowed by the same two
steps inside it.  Nothing is unpivoted, shuffled or sorted but the brought
values, and a value that many rows share costs nothing.  The second step
counts in numpy over Arrow batches: as one aggregate it has hundreds of
expressions, which take longer to plan than to run.

``approx`` uses ``percentile_approx`` with the given accuracy.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.session import ship_package
from tillcast.sources.sinks import stored

ACCURACY = 2_000        # of the sketches: a rank is off by n / ACCURACY at most
KEEP = 20_000           # values of a bracket that are brought to the driver
SMALL_VALUES = 1_000_000  # of all columns, up to which they are brought instead
BRACKETS = 240          # in one aggregate


def _approx(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int) -> dict:
    arr = F.array(*[F.lit(float(p)) for p in probs])
    row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), arr, accuracy).alias(f"q{i}")
                   for i, c in enumerate(cols)]).first()
    return {c: (list(row[f"q{i}"]) if row[f"q{i}"] is not None else None)
            for i, c in enumerate(cols)}


@dataclass
class _Bracket:
    """Ranks of a column that lie among the ``size`` values inside an open
    interval, ``base`` values being at or below its lower end."""
    col: int
    ranks: list[int]
    base: int
    size: int
    low: float | None = None
    high: float | None = None

    def inside(self, v: Column) -> Column:
        cond = F.lit(True)
        if self.low is not None:
            cond = cond & (v > self.low)
        if self.high is not None:
            cond = cond & (v < self.high)
        return cond

    def split(self, x: float, y: float, lt: int, at_x: int, mid: int, at_y: int, held: list[float] | None,
              found: dict[tuple[int, int], float]) -> list[_Bracket]:
        """What the counts around [x, y] tell: ranks that are found, and narrower
        brackets of the others.  The counts are of values inside this one."""
        runs = [(lt, None), (at_x, x), (mid, held and sorted(held)), (at_y, y), (self.size - lt - at_x - mid - at_y, None)]
        ends = [(self.low, x), None, (x, y), None, (y, self.high)]
        rest, base = [], self.base
        for (many, value), end in zip(runs, ends, strict=True):
            here = [r for r in self.ranks if base < r <= base + many]
            if here and isinstance(value, list):
                found.update({(self.col, r): value[r - base - 1] for r in here})
            elif here and value is not None:
                found.update({(self.col, r): value for r in here})
            elif here:
                rest.append(_Bracket(self.col, here, base, many, *end))
            base += many
        return rest


def _value(df: DataFrame, col: str) -> Column:
    """The column as double without nan, which counts as the largest value."""
    v = F.col(col).cast("double")
    return F.when(~F.isnan(v), v) if dict(df.dtypes)[col] in ("double", "float") else v


def _counted(brackets: list[_Bracket], ends: list[list[float]], keep: list[bool]):
    """A row for each bracket, of one task: how many values inside it are below,
    at, between and at the two ends, and those between if they are kept.
    Columns are double, in the order of the brackets' ``col``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(brackets), 4), np.int64)
        held: list[list[np.ndarray]] = [[] for _ in brackets]
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in {b.col for b in brackets}}
            for i, (b, (x, y)) in enumerate(zip(brackets, ends, strict=True)):
                v = cols[b.col]
                if b.low is not None or b.high is not None:
                    v = v[(v > (-np.inf if b.low is None else b.low)) & (v < (np.inf if b.high is None else b.high))]
                counts[i, 0] += np.count_nonzero(v < x)
                counts[i, 1] += np.count_nonzero(v == x)
                if x < y:
                    between = v[(v > x) & (v < y)]
                    counts[i, 2] += len(between)
                    counts[i, 3] += np.count_nonzero(v == y)
                    if keep[i] and len(between):
                        held[i].append(between)
        lists = [np.concatenate(h) if h else np.zeros(0) for h in held]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(brackets), dtype=np.int32)), *[pa.array(counts[:, k]) for k in range(4)],
                                          pa.array(lists, pa.list_(pa.float64()))], names=["i", "lt", "x", "mid", "y", "held"])
    return run


def _round(df: DataFrame, brackets: list[_Bracket], found: dict[tuple[int, int], float],
           ends: list[list[float]] | None = None) -> list[_Bracket]:
    """One narrowing of all brackets over the double columns v0, v1, ...: a sketch
    (unless its points are given) and the counts."""
    if ends is None:
        exprs = []
        for i, b in enumerate(brackets):
            near = [(b.ranks[0] - b.base) / b.size, (b.ranks[-1] - b.base) / b.size]
            v = F.col(f"v{b.col}")
            exprs.append(F.percentile_approx(F.when(b.inside(v), v), _points(*near), ACCURACY).alias(f"e{i}"))
        row = df.agg(*exprs).first()
        ends = [row[f"e{i}"] for i in range(len(brackets))]
    # the sketch bounds what lies between its two values
    keep = [b.ranks[-1] - b.ranks[0] + 1 + 8 * b.size / ACCURACY <= KEEP for b in brackets]
    parts = df.mapInArrow(_counted(brackets, ends, keep), "i int, lt long, x long, mid long, y long, held array<double>")
    rows = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in ("lt", "x", "mid", "y")], F.flatten(F.collect_list("held")).alias("held")).collect()
    return [n for r in rows for n in brackets[r.i].split(*ends[r.i], r.lt, r.x, r.mid, r.y, r.held if keep[r.i] else None, found)]


def _points(low: float, high: float) -> Column:
    return F.array(F.lit(max(0.0, low - 3 / ACCURACY)), F.lit(min(1.0, high + 3 / ACCURACY)))


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], method: str = "exact",
              accuracy: int = 100000, store: bool = False) -> dict[str, list[float] | None]:
    """``{column: [q(p) for p in probs]}`` over non-null values (None when a
    column has no non-null value).  The rows are read two or three times;
    ``store`` writes the columns first, for frames that are costly to read."""
    cols, probs = list(cols), [float(p) for p in probs]
    if not cols:
        return {}
    if method == "approx":
        return _approx(df, cols, probs, accuracy)
    if method != "exact":
        raise ValueError(f"unknown quantile method {method!r}")
    ship_package(df.sparkSession)
    df = df.select(*cols)
    if store:
        df = stored(df, "columns")
    df = df.select(*cols, *[_value(df, c).alias(f"v{i}") for i, c in enumerate(cols)])
    names = [f"v{i}" for i in range(len(cols))]
    values = [F.col(v) for v in names]
    df = df.toDF(*[f"c{i}" for i in range(len(cols))], *names)
    sketch = [F.percentile_approx(v, F.concat(*[_points(p, p) for p in probs]), ACCURACY).alias(f"e{i}") for i, v in enumerate(values)]
    seen = df.agg(*sketch, *[F.count(v).alias(f"n{i}") for i, v in enumerate(values)],
                  *[F.count(f"c{i}").alias(f"all{i}") for i in range(len(cols))]).first()
    counts = [seen[f"all{i}"] for i in range(len(cols))]
    known = [seen[f"n{i}"] for i in range(len(cols))]
    pairs = [[(low, min(low + 1, n)) for low in (math.floor((n - 1) * p) + 1 for p in probs)] if n else [] for n in counts]
    found: dict[tuple[int, int], float] = {}
    wanted = [sorted({r for pair in p for r in pair if r <= k}) for p, k in zip(pairs, known, strict=True)]
    if sum(known) <= SMALL_VALUES:
        row = df.agg(*[F.collect_list(v).alias(f"v{i}") for i, v in enumerate(values)]).first()
        for i, w in enumerate(wanted):
            inside = sorted(row[f"v{i}"])
            found.update({(i, r): inside[r - 1] for r in w})
    else:
        open_ = []
        for i, p in enumerate(pairs):
            for j, pair in enumerate(p):
                ranks = sorted({r for r in pair if r <= known[i]})
                if ranks:
                    open_.append((_Bracket(i, ranks, 0, known[i]), seen[f"e{i}"][2 * j:2 * j + 2]))
        rest: list[_Bracket] = []
        for at in range(0, len(open_), BRACKETS):
            part = open_[at:at + BRACKETS]
            rest += _round(df.select(*names), [b for b, _ in part], found, [e for _, e in part])
        while rest:
            rest = [b for at in range(0, len(rest), BRACKETS) for b in _round(df.select(*names), rest[at:at + BRACKETS], found)]
    out: dict[str, list[float] | None] = {}
    for i, (c, n) in enumerate(zip(cols, counts, strict=True)):
        out[c] = None if not n else []
        for p, (low, up) in zip(probs, pairs[i], strict=True) if n else ():
            a, b = (found.get((i, r), math.nan) for r in (low, up))      # ranks above all numbers are nan
            h = (n - 1) * p
            part = h - math.floor(h)
            out[c].append(a if part == 0 or a == b else a + part * (b - a))
    return out
