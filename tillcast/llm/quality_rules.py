"""Quality rules: counted rules, then a calibrated n-gram classifier.

The classifier is a logistic regression over hashed word (1, 2) and
character (2, 3, 4) n-grams: the mean weight of a text's n-grams of each
kind, plus a bias.  It is trained on a bounded sample of labelled rows
(SAMPLE_ROWS of each class), its margin is calibrated to a probability
(Platt) on a part of the sample that the weights haven't seen, and texts
are kept from a fixed probability on.  Texts are scored in Arrow batches as
flat arrays: a batch is one run of numpy operations, not one for each text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import SPACE, SPACE_BYTES, pick, ready

SAMPLE_ROWS = 1500       # labelled rows of each class that the classifier learns from, about
BUCKETS = 1 << 18
KEEP = 0.5               # probability of good quality from which a text is kept
MIN_WORDS = 20
MAX_REPEAT = (30, 100)   # repeated words of all words
WINDOW = 8
CHUNK = 1 << 19          # characters that are scored at a time

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

KINDS = (("word", 1), ("word", 2), ("char", 2), ("char", 3), ("char", 4))
SCALE = 30.0             # of an n-gram's share in its text
ROUNDS, RATE, RIDGE = 250, 0.05, 1e-6

ODD = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)
BASE_INVERSE = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Batch:
    """Texts as flat arrays of bytes, words and code points."""

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        data = [t.encode() for t in texts]
        raw = np.frombuffer(b" ".join(data) + b" ", np.uint8)
        blank = np.zeros(256, bool)
        blank[list(SPACE_BYTES)] = True
        gap = blank[raw]
        start = np.flatnonzero(~gap & np.r_[True, gap[:-1]])
        end = np.flatnonzero(~gap & np.r_[gap[1:], True]) + 1
        power = np.full(len(raw), BASE)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        total = np.r_[np.uint64(0), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power)]
        inverse = np.full(len(raw), BASE_INVERSE)
        inverse[0] = 1
        np.multiply.accumulate(inverse, out=inverse)
        self.words = mixed((total[end] - total[start]) * inverse[start])
        first = np.r_[0, np.cumsum([len(d) + 1 for d in data])]
        self.word_at = np.searchsorted(start, first)           # first word of each text, and the end
        self.char_at = np.r_[0, np.cumsum([len(t) for t in texts])]
        self.chars = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)

    def grams(self, kind: str, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all n-grams, and each text's first one and number."""
        flat, at = (self.words, self.word_at) if kind == "word" else (self.chars, self.char_at)
        size = np.maximum(0, np.diff(at) - n + 1)
        total = max(0, len(flat) - n + 1)
        h = flat[:total] * ODD + np.uint64(n)
        for k in range(1, n):
            h = (h ^ flat[k:k + total]) * ODD
        bucket = (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)
        return bucket, at[:-1], size

    def sums(self, values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Sum of each text's values; each text is added up by itself."""
        out = np.zeros(len(first))
        some = np.flatnonzero(size > 0)
        if len(some):
            ends = np.c_[first[some], first[some] + size[some]].ravel()
            out[some] = np.add.reduceat(np.r_[values, values.dtype.type(0)], ends)[::2]
        return out

    def repeated_words(self) -> np.ndarray:
        """Words of each text in windows of WINDOW words that it has twice."""
        count = np.diff(self.word_at)
        total = max(0, len(self.words) - WINDOW + 1)
        owner = np.repeat(np.arange(len(count)), count)
        spot = np.flatnonzero(owner[:total] == owner[WINDOW - 1:WINDOW - 1 + total])
        out = np.zeros(len(count), np.int64)
        if not len(spot):
            return out
        h = mixed(owner[spot].astype(np.uint64) + ODD)
        for k in range(WINDOW):
            h = (h ^ self.words[spot + k]) * ODD
            h ^= h >> np.uint64(29)
        order = np.argsort(h)
        same = h[order[1:]] == h[order[:-1]]
        twice = np.zeros(len(spot), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        step = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(step, spot[twice], 1)
        np.add.at(step, spot[twice] + WINDOW, -1)
        inside = np.cumsum(step[:-1]) > 0
        return np.bincount(owner[inside], minlength=len(count))


def rule_counts(texts: list[str], batch: Batch) -> dict[str, np.ndarray]:
    number = lambda f: np.array([f(t) for t in texts], np.int64)

    def dup_lines(text: str) -> int:
        seen, n = set(), 0
        for line in text.split("\n"):
            if line.strip(SPACE):
                n += line in seen
                seen.add(line)
        return n

    return {"n_words": np.diff(batch.word_at), "word_chars": number(lambda t: len(t) - sum(map(t.count, SPACE))),
            "n_symbols": number(lambda t: sum(map(t.count, SYMBOLS))), "n_dup_lines": number(dup_lines), "n_repeat_words": batch.repeated_words()}


class Classifier:
    """Weights by kind and bucket, bias, and the calibration (a, b)."""

    def __init__(self) -> None:
        self.weights = np.zeros((len(KINDS), BUCKETS), np.float32)
        self.bias, self.a, self.b = 0.0, 1.0, 0.0

    def margins(self, batch: Batch) -> np.ndarray:
        out = np.full(len(batch.texts), self.bias)
        for w, (kind, n) in zip(self.weights, KINDS, strict=True):
            bucket, first, size = batch.grams(kind, n)
            out += SCALE * batch.sums(w[bucket], first, size) / np.maximum(1, size)
        return out

    def probability(self, batch: Batch) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.a * self.margins(batch) + self.b, -40, 40)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct buckets of each text (kind times BUCKETS plus bucket) and their shares."""
    for batch in batches:
        for i in range(batch.num_rows):
            flat = Batch([batch.column(1)[i].as_py()])
            keys, values = [], []
            for k, (kind, n) in enumerate(KINDS):
                bucket, _, size = flat.grams(kind, n)
                if size[0]:
                    key, many = np.unique(bucket[:size[0]], return_counts=True)
                    keys.append(key.astype(np.int32) + k * BUCKETS)
                    values.append((SCALE * many / size[0]).astype(np.float32))
            key = np.concatenate(keys) if keys else np.empty(0, np.int32)
            value = np.concatenate(values) if values else np.empty(0, np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(2).slice(i, 1), pa.array([key.tobytes()]), pa.array([value.tobytes()])],
                                             names=["doc_id", "label", "keys", "shares"])


def logistic(keys: list[np.ndarray], shares: list[np.ndarray], label: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Adam on the full batch; both classes have the same weight altogether.
    The sample is held twice, by row and by feature, as four-byte numbers."""
    many = np.array([len(k) for k in keys])
    flat, value = np.concatenate(keys), np.concatenate(shares)
    seen = np.bincount(flat, minlength=size).astype(np.int32)
    used = np.flatnonzero(seen)
    flat = (np.cumsum(seen > 0, dtype=np.int32) - 1)[flat]
    order = np.argsort(flat, kind="stable").astype(np.int32)
    row = np.repeat(np.arange(len(keys), dtype=np.int32), many)[order]
    by_feature = value[order]
    del order
    some, row_at, feature_at = many > 0, (np.cumsum(many) - many)[many > 0], np.r_[0, np.cumsum(seen[used])[:-1]]
    weight = np.where(label > 0, 0.5 / max(1, label.sum()), 0.5 / max(1, (1 - label).sum()))
    w, bias = np.zeros(len(used), np.float32), 0.0
    m, v, mb, vb = np.zeros(len(used), np.float32), np.zeros(len(used), np.float32), 0.0, 0.0
    for t in range(1, ROUNDS + 1):
        margin = np.full(len(keys), bias)
        if len(flat):
            margin[some] += np.add.reduceat(value * w[flat], row_at)
        error = weight * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - label)
        gb = error.sum()
        g = RIDGE * w + (np.add.reduceat(by_feature * error.astype(np.float32)[row], feature_at) if len(flat) else 0)
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        bias -= RATE * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    out = np.zeros(size, np.float32)
    out[used] = w
    return out, bias


def platt(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Newton steps for P(1) = 1 / (1 + exp(-(a margin + b))), with Platt's
    smoothed targets so that a separable sample stays finite."""
    good, bad = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.c_[margin, np.ones(len(margin))]
    p = np.array([1.0, 0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ p, -40, 40)))
        hessian = (x * (weight * q * (1 - q))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (q - target)))
        p -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(p[0]), float(p[1])


def train_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
                  label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Classifier | None:
    """From labelled rows (label 1 good, 0 bad), about ``sample_rows`` of each
    class by a hash of the id.  An id whose labels contradict each other
    teaches nothing, nor do null ids, labels and texts.  None if a class has
    no row."""
    spark = docs.sparkSession
    ready(spark)
    told = pick(labels, doc_id=label_id, label=label_col).select(F.col("doc_id").cast("long"), F.col("label").cast("int"))
    told = (told.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id")
            .agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most").drop("most"))
    count = {r.label: r["count"] for r in told.groupBy("label").count().collect()}
    if len(count) < 2:
        return None
    top = 1 << 30
    at = F.pmod(F.xxhash64(F.lit("quality sample"), "doc_id"), F.lit(top))
    limit = F.when(F.col("label") == 1, top * sample_rows // max(sample_rows, count[1])).otherwise(top * sample_rows // max(sample_rows, count[0]))
    drawn = told.filter(at <= limit)
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("text IS NOT NULL")
    # the sample's ids and labels: sample_rows of each class, so small enough to broadcast
    seen = rows.join(F.broadcast(drawn), "doc_id").select("doc_id", "text", "label").mapInArrow(_features, "doc_id long, label int, keys binary, shares binary").collect()
    seen.sort(key=lambda r: (r.doc_id, r["keys"]))
    label = np.array([r.label for r in seen], np.float64)
    ids = np.array([r.doc_id for r in seen], np.int64)
    if len(set(label.tolist())) < 2:
        return None
    keys, shares = [np.frombuffer(r["keys"], np.int32) for r in seen], [np.frombuffer(r.shares, np.float32) for r in seen]
    del seen
    apart = mixed(ids.view(np.uint64)) % np.uint64(4) == 0   # a quarter is for the calibration
    if len(set(label[apart].tolist())) < 2 or len(set(label[~apart].tolist())) < 2:
        apart = np.zeros(len(ids), bool)
    learn = np.flatnonzero(~apart)
    model = Classifier()
    flat, model.bias = logistic([keys[i] for i in learn], [shares[i] for i in learn], label[learn], model.weights.size)
    model.weights = flat.reshape(model.weights.shape)
    test = np.flatnonzero(apart) if apart.any() else learn
    margin = np.array([model.bias + float((flat[keys[i]].astype(np.float64) * shares[i]).sum()) for i in test])
    whole = np.where(label[test] > 0, count[1] / label.sum(), count[0] / (1 - label).sum())   # the classes' shares among all labelled rows
    model.a, model.b = platt(margin, label[test], whole / whole.mean())
    return model


def _scoring(shared, keep: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                upto, held = at, 0
                while upto < len(texts) and held <= CHUNK:
                    held += len(texts[upto])
                    upto += 1
                flat = Batch(texts[at:upto])
                n = rule_counts(texts[at:upto], flat)
                failed = (n["n_words"] < MIN_WORDS) | (MAX_REPEAT[1] * n["n_repeat_words"] > MAX_REPEAT[0] * n["n_words"])
                score = np.round(model.probability(flat), 6) if model else np.ones(upto - at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, upto - at), *[pa.array(c) for c in n.values()], pa.array(failed), pa.array(score), pa.array(~failed & (score >= keep))],
                    names=["doc_id", *n, "base_failed", "score", "kept"])
                at = upto
    return run


def apply_quality(docs: DataFrame, model: Classifier | None, id_col: str = "doc_id", text_col: str = "text", keep: float = KEEP) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, score, kept.

    Null text has no words and fails the rules, like any text of fewer than
    MIN_WORDS words.  Without a model the rules alone decide (score 1).
    Repeated rows are scored each; an empty table gives no rows.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_scoring(shared, keep), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
                                                   "base_failed boolean, score double, kept boolean")


def quality_rules(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """Trained on the labelled rows of ``docs``, applied to all."""
    return apply_quality(docs, train_quality(docs, labels, **columns), columns.get("id_col", "doc_id"), columns.get("text_col", "text"))
