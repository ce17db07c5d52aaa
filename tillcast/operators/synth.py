"""Synthetic rows for days not yet observed: a Gaussian copula.

Fit (on a calendar-aggregated table, bounded by the number of days):
* marginals: exact 101-point percentile grids, or fitted families
  (``marginals``: truncated normal, gamma, beta) where they are asked for;
* categorical groups (a fixed combination of columns) become one latent
  column: the fitted rows, sorted by combination, are numbered; a
  combination's score is the middle of its numbers, and a drawn score is a
  number that the rows are joined on again.  Any number of combinations
  works, and a drawn one always occurs in the data;
* normal scores per row in ``mapInPandas`` (numpy interpolation), then the
  latent correlation with ``Correlation.corr`` (executors aggregate the
  Gramian; only the k x k matrix reaches the driver).

Sample: ``spark.range(n)`` -> ``mapInPandas``: standard normals from a
counter-based hash of (row id, column, seed) - the same rows on every
partitioning and retry - correlated with the Cholesky factor, then mapped
through the marginals.  ``sample_with_facts`` draws the other columns
conditionally on known calendar facts (conditional Gaussian).

Quality scores (KS / TV complements, correlation and contingency
similarity) are plain DataFrame aggregates.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from typing import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tillcast.operators.encoders import category_counts
from tillcast.operators.marginals import Marginal, fit_marginals
from tillcast.operators.profile import named_pairs
from tillcast.operators.quantiles import quantiles
from tillcast.operators.ranking import global_row_number
from tillcast.session import ship_package
from tillcast.sources.sinks import stored

GRID = [i / 100 for i in range(101)]
U_EPS = 1e-6

# Rational approximation of the inverse normal CDF (relative
# error about 1.15e-9), coefficients a, b, c, d and the break point.
ICDF_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
          1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
ICDF_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
          6.680131188771972e+01, -1.328068155288572e+01]
ICDF_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
          -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
ICDF_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
          3.754408661907416e+00]
ICDF_LOW = 0.02425


def norm_ppf(u: np.ndarray) -> np.ndarray:
    u = np.clip(np.asarray(u, dtype=float), U_EPS, 1 - U_EPS)
    out = np.empty_like(u)
    lo = u < ICDF_LOW
    hi = u > 1 - ICDF_LOW
    mid = ~(lo | hi)
    a, b, c, d = ICDF_A, ICDF_B, ICDF_C, ICDF_D
    if lo.any():
        q = np.sqrt(-2 * np.log(u[lo]))
        out[lo] = ((((((c[0]*q+c[1])*q+c[2])*q+c[3])*q+c[4])*q+c[5]) /
                   ((((d[0]*q+d[1])*q+d[2])*q+d[3])*q+1))
    if hi.any():
        q = np.sqrt(-2 * np.log(1 - u[hi]))
        out[hi] = -((((((c[0]*q+c[1])*q+c[2])*q+c[3])*q+c[4])*q+c[5]) /
                    ((((d[0]*q+d[1])*q+d[2])*q+d[3])*q+1))
    if mid.any():
        q = u[mid] - 0.5
        r = q * q
        out[mid] = ((((((a[0]*r+a[1])*r+a[2])*r+a[3])*r+a[4])*r+a[5])*q /
                    (((((b[0]*r+b[1])*r+b[2])*r+b[3])*r+b[4])*r+1))
    return out


def _erfc(x: np.ndarray) -> np.ndarray:
    from tillcast.operators.profile import ERFC_COEFFS
    z = np.abs(x)
    t = 1.0 / (1.0 + 0.5 * z)
    poly = np.full_like(z, ERFC_COEFFS[-1])
    for c in reversed(ERFC_COEFFS[:-1]):
        poly = c + t * poly
    ans = t * np.exp(-z * z + poly)
    return np.where(x >= 0, ans, 2.0 - ans)


def norm_cdf(z: np.ndarray) -> np.ndarray:
    z = np.asarray(z, dtype=float)
    return 0.5 * _erfc(-z / math.sqrt(2.0))


def _splitmix(x: np.ndarray) -> np.ndarray:
    """Counter-based 64-bit hash (splitmix64 finaliser) -> uniform (0, 1)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def hashed_normals(ids: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Standard normals (len(ids) x k), a pure function of (id, column, seed)."""
    ids = np.asarray(ids, dtype=np.int64).astype(np.uint64)
    cols = np.arange(k, dtype=np.uint64)
    with np.errstate(over="ignore"):
        base = (ids[:, None] * np.uint64(2 * k + 1) + cols[None, :] * np.uint64(2)
                + np.uint64(seed) * np.uint64(0x632BE59BD9B4E019))
    u1, u2 = _splitmix(base), _splitmix(base + np.uint64(1))
    return np.sqrt(-2.0 * np.log(u1)) * np.cos(2.0 * math.pi * u2)


def _mid_cdf(x: np.ndarray, grid: np.ndarray) -> np.ndarray:
    """Empirical CDF from the percentile grid; repeated grid values (atoms)
    take the middle of their probability span."""
    probs = np.asarray(GRID)
    xs, inv = np.unique(grid, return_inverse=True)
    ps = np.array([probs[inv == i].mean() for i in range(len(xs))])
    if len(xs) == 1:
        return np.full(len(x), 0.5)
    return np.interp(x, xs, ps)


@dataclass
class CopulaModel:
    continuous: list[str]
    grids: dict[str, list[float]]
    decimals: dict[str, int]
    minmax: dict[str, tuple[float, float]]
    groups: list[list[str]] = field(default_factory=list)       # categorical groups
    numbered: list[DataFrame] = field(default_factory=list)     # (pos, columns of the group)
    onehot: list[list[str]] = field(default_factory=list)
    corr: np.ndarray | None = None
    n_rows: int = 0
    marginals: dict[str, Marginal] = field(default_factory=dict)   # of columns with a fitted family

    @property
    def latent(self) -> list[str]:
        return self.continuous + ["__grp%d" % i for i in range(len(self.groups))]

    @property
    def output(self) -> list[str]:
        return self.continuous + [c for g in self.groups for c in g]


MAX_DECIMALS = 6   # to which drawn values are rounded at most


def _decimals(df: DataFrame, cols: Sequence[str], max_dec: int = MAX_DECIMALS) -> dict[str, int]:
    aggs = []
    for c in cols:
        for d in range(max_dec + 1):
            x = F.col(c).cast("double") * F.lit(10.0 ** d)
            aggs.append(F.max(F.abs(x - F.round(x))).alias(f"{c}__{d}"))
    row = df.agg(*aggs).first()
    out = {}
    for c in cols:
        out[c] = max_dec
        for d in range(max_dec + 1):
            v = row[f"{c}__{d}"]
            if v is None or v < 1e-6:
                out[c] = d
                break
    return out


def _scorer(model: CopulaModel):
    """Normal scores of a column's values, by its marginal."""
    grids = {c: np.asarray(model.grids[c], dtype=float) for c in model.continuous}
    fitted = dict(model.marginals)
    return lambda c, x: norm_ppf(fitted[c].cdf(x) if c in fitted else _mid_cdf(x, grids[c]))


def _scores_fn(model: CopulaModel):
    score = _scorer(model)
    latent, continuous = model.latent, list(model.continuous)

    def fn(batches):
        for pdf in batches:
            out = {c: score(c, pdf[c].to_numpy(dtype=float)) for c in continuous}
            for c in latent[len(continuous):]:
                out[c] = norm_ppf(pdf[c].to_numpy(dtype=float))
            yield pd.DataFrame(out)[latent]
    return fn


def with_group_scores(src: DataFrame, model: CopulaModel) -> DataFrame:
    """``src`` with the middle position (0 to 1) of each group's combination.
    A combination that the fitted rows don't have fails the job."""
    out = src
    for gi, (g, numbered) in enumerate(zip(model.groups, model.numbered)):
        mid = numbered.groupBy(*g).agg(((F.min("pos") + F.max("pos") - 1) / F.lit(2.0 * model.n_rows)).alias(f"__grp{gi}"))
        mid = mid.select(*[F.col(c).alias(f"__{c}") for c in g], f"__grp{gi}")
        same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in g]
        cond = same[0]
        for s in same[1:]:
            cond = cond & s
        miss = F.raise_error(F.concat(F.lit(f"combination of {g} that was not fitted: "), F.to_json(F.struct(*g))))
        out = out.join(mid, cond, "left").withColumn(f"__grp{gi}", F.coalesce(f"__grp{gi}", miss.cast("double"))).drop(*[f"__{c}" for c in g])
    return out


def fit_copula(df: DataFrame, columns: Sequence[str] | None = None,
               groups: Sequence[Sequence[str]] = (), onehot: Sequence[Sequence[str]] = (),
               max_decimals: int = MAX_DECIMALS, families: dict[str, str] | None = None,
               default_family: str | None = None) -> CopulaModel:
    """``families``: the family of a column's marginal (truncnorm, gamma, beta, or
    ``nearest`` for the one with the least KS distance), ``default_family``
    that of the other columns; None keeps the percentile grid."""
    spark = df.sparkSession
    ship_package(spark)
    grouped = [c for g in groups for c in g]
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    cols = [c for c in (columns or num) if c not in grouped]
    # written once: the passes below and the combinations read the same values
    src = stored(df.select(*cols, *grouped).na.drop(), "copula")
    q = quantiles(src, cols, GRID)
    mm = src.agg(*[e for c in cols for e in (F.min(c).alias(f"{c}__lo"),
                                              F.max(c).alias(f"{c}__hi"))]).first()
    model = CopulaModel(
        continuous=cols, grids={c: q[c] for c in cols}, decimals=_decimals(src, cols, max_decimals),
        minmax={c: (float(mm[f"{c}__lo"]), float(mm[f"{c}__hi"])) for c in cols},
        groups=[list(g) for g in groups], onehot=[list(g) for g in onehot], n_rows=src.count())
    wanted = {c: f for c in cols if (f := (families or {}).get(c, default_family)) is not None}
    if wanted:
        named = {c: f for c, f in wanted.items() if f != "nearest"}
        fits = fit_marginals(src, list(wanted), named, grids={c: q[c] for c in wanted})
        model.marginals = {c: m for c, (m, _) in fits.items()}
    for g in model.groups:
        order = [F.col(c) for c in g]
        model.numbered.append(stored(global_row_number(src.select(*g), order, out="pos").select("pos", *g), "combinations"))
    latent_schema = ", ".join(f"`{c}` double" for c in model.latent)
    scores = with_group_scores(src, model).mapInPandas(_scores_fn(model), latent_schema)
    vec = VectorAssembler(inputCols=model.latent, outputCol="z").transform(scores)
    corr = Correlation.corr(vec, "z", "pearson").first()[0].toArray()
    corr = np.nan_to_num(corr, nan=0.0)
    np.fill_diagonal(corr, 1.0)
    model.corr = corr
    return model


def _psd_cholesky(m: np.ndarray) -> np.ndarray:
    w, v = np.linalg.eigh((m + m.T) / 2)
    w = np.clip(w, 1e-9, None)
    fixed = (v * w) @ v.T
    return np.linalg.cholesky(fixed + 1e-12 * np.eye(len(m)))


@dataclass
class _Decoder:
    """What tasks need to turn latent normals into columns."""
    continuous: list[str]
    grids: list[np.ndarray]
    minmax: list[tuple[float, float]]
    decimals: list[int]
    onehot: list[list[str]]
    n_groups: int
    n_rows: int
    fitted: list[Marginal | None]

    @classmethod
    def of(cls, m: CopulaModel) -> _Decoder:
        return cls(m.continuous, [np.asarray(m.grids[c], dtype=float) for c in m.continuous], [m.minmax[c] for c in m.continuous],
                   [m.decimals[c] for c in m.continuous], m.onehot, len(m.groups), m.n_rows,
                   [m.marginals.get(c) for c in m.continuous])

    def __call__(self, z: np.ndarray) -> dict[str, np.ndarray]:
        """Latent normals (n x k, latent order) -> columns; of a group the position
        among the fitted rows."""
        out = {}
        u = norm_cdf(z)
        probs = np.asarray(GRID)
        for j, c in enumerate(self.continuous):
            lo, hi = self.minmax[j]
            if self.fitted[j] is not None:
                out[c] = np.round(self.fitted[j].ppf(u[:, j]), self.decimals[j])
                continue
            out[c] = np.round(np.clip(np.interp(u[:, j], probs, self.grids[j]), lo, hi), self.decimals[j])
        for gi in range(self.n_groups):
            at = np.floor(u[:, len(self.continuous) + gi] * self.n_rows) + 1
            out[f"__pos{gi}"] = np.clip(at, 1, self.n_rows).astype(np.int64)
        for g in self.onehot:
            if all(c in out for c in g):
                arg = np.argmax(np.column_stack([out[c] for c in g]), axis=1)
                for k, c in enumerate(g):
                    out[c] = (arg == k).astype(float)
        return out


def _with_groups(drawn: DataFrame, model: CopulaModel, columns: Sequence[str]) -> DataFrame:
    """Positions replaced by the combinations that stand there."""
    for gi, (g, numbered) in enumerate(zip(model.groups, model.numbered)):
        drawn = drawn.join(numbered.withColumnRenamed("pos", f"__pos{gi}"), f"__pos{gi}", "left")
    return drawn.select(*columns)


def _positions(model: CopulaModel) -> str:
    return "".join(f", __pos{gi} long" for gi in range(len(model.groups)))


ROWS_PER_TASK = 1 << 20   # that a task draws, at most


def sample_copula(spark: SparkSession, model: CopulaModel, rows: int | None = None,
                  factor: int = 1, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """Draw ``rows * factor`` rows (default: as many as were fitted)."""
    ship_package(spark)
    n = (rows if rows is not None else model.n_rows) * factor
    L = _psd_cholesky(model.corr)
    k, decode = len(model.latent), _Decoder.of(model)
    continuous = list(model.continuous)
    schema = "sample_id long" + "".join(f", `{c}` double" for c in continuous) + _positions(model)

    def gen(batches):
        for pdf in batches:
            ids = pdf["id"].to_numpy()
            yield pd.DataFrame({"sample_id": ids, **decode(hashed_normals(ids, k, seed) @ L.T)})

    parts = partitions or max(spark.sparkContext.defaultParallelism, -(-n // ROWS_PER_TASK))
    drawn = spark.range(0, n, 1, parts).mapInPandas(gen, schema)
    return _with_groups(drawn, model, ["sample_id", *model.output])


def sample_with_facts(model: CopulaModel, facts: DataFrame, id_col: str = "DateKey",
                      seed: int = 42) -> DataFrame:
    """Draw the non-fact columns conditionally on the fact columns of each
    row of ``facts`` (conditional Gaussian on the latent scale)."""
    spark = facts.sparkSession
    ship_package(spark)
    known = [c for c in facts.columns if c in model.continuous]
    unknown_idx = [i for i, c in enumerate(model.latent) if c not in known]
    known_idx = [model.latent.index(c) for c in known]
    S = model.corr
    Skk = S[np.ix_(known_idx, known_idx)]
    Suk = S[np.ix_(unknown_idx, known_idx)]
    Suu = S[np.ix_(unknown_idx, unknown_idx)]
    A = Suk @ np.linalg.pinv(Skk)
    Lc = _psd_cholesky(Suu - A @ Suk.T)
    score = _scorer(model)
    new = [c for c in model.continuous if c not in known]
    id_type = dict(facts.dtypes)[id_col]
    schema = (f"`{id_col}` {id_type}" + "".join(f", `{c}` double" for c in [*known, *new]) + _positions(model))
    k, decode = len(model.latent), _Decoder.of(model)
    names = [f"__pos{gi}" for gi in range(len(model.groups))]
    src = facts.select(id_col, *known, F.xxhash64(id_col).alias("__rid"))

    def gen(batches):
        for pdf in batches:
            zk = np.column_stack([score(c, pdf[c].to_numpy(dtype=float)) for c in known]) if known else np.zeros((len(pdf), 0))
            eps = hashed_normals(pdf["__rid"].to_numpy(), len(unknown_idx), seed)
            zu = zk @ A.T + eps @ Lc.T
            z = np.zeros((len(pdf), k))
            z[:, known_idx] = zk
            z[:, unknown_idx] = zu
            dec = decode(z)
            data = {id_col: pdf[id_col].to_numpy()}
            for c in known:
                data[c] = pdf[c].to_numpy(dtype=float)
            for c in [*new, *names]:
                data[c] = dec[c]
            yield pd.DataFrame(data)

    drawn = src.mapInPandas(gen, schema)
    return _with_groups(drawn, model, [id_col, *known, *[c for c in model.output if c not in known]])


def detect_metadata(df: DataFrame, forced: Sequence[str] = (), exclude: Sequence[str] = (),
                    max_binary: int = 2) -> DataFrame:
    """Per column: exact number of distinct non-null values and its kind
    (categorical when forced or with at most ``max_binary`` values).  One
    aggregate over all columns."""
    cols = [c for c in df.columns if c not in set(exclude)]
    wide = df.agg(*[F.countDistinct(F.col(c)).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column, n_distinct)")
    return long.withColumn("sdtype", F.when(
        F.col("column").isin(list(forced)) | (F.col("n_distinct") <= max_binary),
        F.lit("categorical")).otherwise(F.lit("numerical")))


# ------------------------------------------------------------ quality scores
def diagnostic(real: DataFrame, synth: DataFrame, numeric: Sequence[str],
               categorical: Sequence[str] = ()) -> DataFrame:
    """Per column: whether both frames have it, whether its type is the same,
    and the share of synthetic values within the real [min, max] (numeric) or
    among the real categories; the share of a missing column is null."""
    spark = real.sparkSession
    types, others = dict(real.dtypes), dict(synth.dtypes)
    both = lambda c: c in types and c in others
    rows = {c: ("numeric", None) for c in numeric} | {c: ("categorical", None) for c in categorical}
    there = [c for c in numeric if both(c)]
    if there:
        rng = real.agg(*[e for c in there for e in (F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi"))])
        inside = synth.crossJoin(F.broadcast(rng)).agg(*[
            F.avg(F.when((F.col(c) >= F.col(f"{c}__lo")) & (F.col(c) <= F.col(f"{c}__hi")),
                         1.0).otherwise(0.0)).alias(c) for c in there]).first()
        rows |= {c: ("numeric", inside[c]) for c in there}
    there = [c for c in categorical if both(c)]
    if there:
        known = category_counts(real, there).select("k", "s").withColumn("known", F.lit(1.0))
        drawn = category_counts(synth, there)
        shares = (drawn.join(known, (drawn.k == known.k) & drawn.s.eqNullSafe(known.s), "left")
                  .groupBy(drawn.k).agg((F.sum(F.coalesce("known", F.lit(0.0)) * F.col("w")) / F.sum("w")).alias("share")))
        rows |= {there[r["k"]]: ("categorical", r["share"]) for r in shares.collect()}   # one for each column
    return spark.createDataFrame(
        [(c, kind, both(c), both(c) and types[c] == others[c], share) for c, (kind, share) in rows.items()],
        "column string, kind string, present boolean, same_type boolean, valid_share double")


def ks_complement(real: DataFrame, synth: DataFrame, cols: Sequence[str]) -> DataFrame:
    """1 - max |F_real - F_synth| per column, over the union of values.

    Value counts per (column, value) of each side are full-joined; the two
    empirical CDFs come from weighted positions (two-level ranking when the
    value set is large), so no task holds a whole column."""
    from tillcast.operators.ranking import cumulative_sums

    idx = {c: i for i, c in enumerate(cols)}

    def long(df, tag):
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(idx[c]).alias("k"), F.col(c).cast("double").alias("v"))
            for c in cols])).alias("p")).select("p.*").where(F.col("v").isNotNull()) \
            .groupBy("k", "v").agg(F.count(F.lit(1)).alias(tag))
    both = long(real, "nr").join(long(synth, "ns"), ["k", "v"], "full").na.fill(0, ["nr", "ns"])
    cum = cumulative_sums(both, ["nr", "ns"]).withColumnsRenamed({"nr_cum": "cr", "ns_cum": "cs"})
    tot = both.groupBy("k").agg(F.sum("nr").alias("tr"), F.sum("ns").alias("ts"))
    cdf = cum.join(F.broadcast(tot), "k")
    names = F.create_map(*[x for c in cols for x in (F.lit(idx[c]), F.lit(c))])
    return cdf.groupBy("k").agg((F.lit(1.0) - F.max(F.abs(
        F.try_divide("cr", "tr") - F.try_divide("cs", "ts")))).alias("ks_complement")) \
        .select(names[F.col("k")].alias("column"), "ks_complement")


def _shares(real: DataFrame, synth: DataFrame, cells: Sequence[Column]) -> DataFrame:
    """(k, s, p, q): share of each category of each cell in either frame.  Both
    frames are read once for all cells; null is a category."""
    def counted(df: DataFrame, side: str) -> DataFrame:
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("k"), c.alias("s")) for i, c in enumerate(cells)])).alias("c"))
        return pairs.select("c.k", "c.s", F.lit(side).alias("side"))
    both = counted(real, "p").unionByName(counted(synth, "q"))
    return _of_totals(both.groupBy("k", "s").agg(F.count_if(F.col("side") == "p").alias("p"), F.count_if(F.col("side") == "q").alias("q")))


def _of_totals(n: DataFrame) -> DataFrame:
    """The counts p and q as shares of their totals by k."""
    total = n.groupBy("k").agg(F.sum("p").alias("np"), F.sum("q").alias("nq"))   # a row for each cell
    return n.join(F.broadcast(total), "k").withColumns({"p": F.try_divide("p", "np"), "q": F.try_divide("q", "nq")}).drop("np", "nq")


BLOCK_ROWS, BLOCK_BYTES = 1 << 17, 64 << 20   # rows whose pairs of values a task counts at a time


def _pair_counts(pairs: Sequence[tuple[int, int]]):
    """Of text columns: (k, a, b, n), the rows of each block by the values of
    each pair of columns.  Values are numbered once a block for all pairs; a
    block gives no more rows than it has for a pair."""
    def counts(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        codes, values = [], []
        for col in table.columns:
            coded = col.cast(pa.large_string()).combine_chunks().dictionary_encode("encode")
            codes.append(coded.indices.to_numpy().astype(np.int64))
            values.append(coded.dictionary)
        for k, (a, b) in enumerate(pairs):
            wide = len(values[b])
            cell = codes[a] * wide + codes[b]
            if len(values[a]) * wide <= 4 * table.num_rows:
                n = np.bincount(cell)
                cell = np.flatnonzero(n)
                n = n[cell]
            else:
                cell, n = np.unique(cell, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), k, np.int32)), values[a].take(pa.array(cell // wide)).cast(pa.string()),
                                              values[b].take(pa.array(cell % wide)).cast(pa.string()), pa.array(n.astype(np.int64))], names=["k", "a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(x.num_rows for x in held) >= BLOCK_ROWS or sum(x.nbytes for x in held) >= BLOCK_BYTES:
                yield from counts(held)
                held = []
        if held:
            yield from counts(held)
    return run


def _pair_shares(real: DataFrame, synth: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """(k, a, b, p, q): share of each pair of values, as text, of each pair of
    columns in either frame; null is a value."""
    ship_package(real.sparkSession)
    cols = list(dict.fromkeys(c for pair in pairs for c in pair))
    at = [(cols.index(a), cols.index(b)) for a, b in pairs]

    def counted(df: DataFrame) -> DataFrame:
        texts = df.select(*[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(cols)])
        return texts.mapInArrow(_pair_counts(at), "k int, a string, b string, n long")
    zero = F.lit(0).cast("long")
    both = counted(real).select("k", "a", "b", F.col("n").alias("p"), zero.alias("q")).union(
        counted(synth).select("k", "a", "b", zero.alias("p"), F.col("n").alias("q")))
    # stored, as the totals read the counts again
    return _of_totals(stored(both.groupBy("k", "a", "b").agg(F.sum("p").alias("p"), F.sum("q").alias("q")), "pairs"))


def _overlap(real: DataFrame, shares: DataFrame, names: Sequence[dict[str, str]], out: str) -> DataFrame:
    """1 - 1/2 sum |p - q| of the categories of each cell, with its names."""
    told = real.sparkSession.createDataFrame([(i, *x.values()) for i, x in enumerate(names)],
                                             "k int, " + ", ".join(f"{c} string" for c in names[0]))
    score = shares.groupBy("k").agg((F.lit(1.0) - F.lit(0.5) * F.sum(F.abs(F.col("p") - F.col("q")))).alias(out))
    return told.join(score, "k").drop("k")


def tv_complement(real: DataFrame, synth: DataFrame, cols: Sequence[str]) -> DataFrame:
    """1 - 1/2 sum |p - q| of category frequencies, per column (null is a
    category of its own)."""
    return _overlap(real, _shares(real, synth, [F.col(c).cast("string") for c in cols]), [{"column": c} for c in cols], "tv_complement")


def contingency_similarity(real: DataFrame, synth: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """The same over the pairs of values of each pair of columns."""
    return _overlap(real, _pair_shares(real, synth, pairs), [{"col_a": a, "col_b": b} for a, b in pairs], "contingency_similarity")


def quality_report(real: DataFrame, synth: DataFrame, numeric: Sequence[str], categorical: Sequence[str], bins: int = 10) -> DataFrame:
    """All column shapes and pair trends by type, and their means:
    (section, name, metric, score).

    Shapes: KS complement of numeric columns, TV complement of categorical
    ones.  Trends: correlation similarity of two numeric columns, else
    contingency similarity, a numeric column in ``bins`` equal parts of the
    real range.  ``overall`` is the mean of the two section means; scores
    that aren't defined (a constant column's correlation) are left out."""
    parts = []
    if numeric:
        parts.append(ks_complement(real, synth, numeric).select(F.lit("shape").alias("section"), F.col("column").alias("name"),
                                                                F.lit("ks_complement").alias("metric"), F.col("ks_complement").alias("score")))
    if categorical:
        parts.append(tv_complement(real, synth, categorical).select(F.lit("shape"), "column", F.lit("tv_complement"), "tv_complement"))
    if len(numeric) > 1:
        parts.append(correlation_similarity(real, synth, numeric).select(F.lit("trend"), F.concat_ws("~", "col_a", "col_b"),
                                                                         F.lit("correlation_similarity"), "correlation_similarity"))
    mixed = [(a, b) for a in numeric for b in categorical] + [(a, b) for i, a in enumerate(categorical) for b in categorical[i + 1:]]
    if mixed:
        rng = real.agg(*[e for c in numeric for e in (F.min(c).alias(f"{c}__lo"), F.max(c).alias(f"{c}__hi"))]).first() if numeric else None

        def binned(df: DataFrame) -> DataFrame:
            part = {c: F.floor(F.try_divide(F.col(c) - F.lit(float(rng[f"{c}__lo"])), F.lit(float(rng[f"{c}__hi"]) - float(rng[f"{c}__lo"]))) * bins)
                    for c in numeric if rng[f"{c}__lo"] is not None}
            return df.select(*categorical, *[F.greatest(F.lit(0), F.least(v, F.lit(bins - 1))).alias(c) for c, v in part.items()],
                             *[F.lit(None).cast("int").alias(c) for c in numeric if c not in part])

        parts.append(contingency_similarity(binned(real), binned(synth), mixed).select(
            F.lit("trend"), F.concat_ws("~", "col_a", "col_b"), F.lit("contingency_similarity"), "contingency_similarity"))
    out = parts[0]
    for x in parts[1:]:
        out = out.union(x)
    out = stored(out.where(F.col("score").isNotNull() & ~F.isnan("score")), "quality")
    sections = out.groupBy("section").agg(F.avg("score").alias("score"))
    means = sections.select(F.lit("mean").alias("section"), F.col("section").alias("name"), F.lit("mean").alias("metric"), "score")
    overall = sections.agg(F.avg("score").alias("score")).select(F.lit("mean").alias("section"), F.lit("overall").alias("name"), F.lit("mean").alias("metric"), "score")
    return out.union(means).union(overall)


def correlation_similarity(real: DataFrame, synth: DataFrame, cols: Sequence[str]) -> DataFrame:
    """1 - |rho_real - rho_synth| / 2 per column pair (one pass each)."""
    j = named_pairs(real, cols, "col_a", "col_b", "r").join(named_pairs(synth, cols, "col_a", "col_b", "s"), ["col_a", "col_b"])
    return j.select("col_a", "col_b", (F.lit(1.0) - F.abs(F.col("r") - F.col("s")) / F.lit(2.0))
                    .alias("correlation_similarity"))
