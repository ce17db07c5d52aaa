"""Ranked lexical search over range-maximum tables.

Each task keeps, for a block of documents, the posting list of every query
term with its impacts (what the term adds to a document's score) and a sparse
table of range maxima over it.  An item's search is best-first over document
intervals: an interval's bound is the sum over the item's terms of the
greatest impact inside it, two table reads a term.  The intervals with the
greatest bounds are split at the document of their greatest impact; that
document is scored, the two rests get bounds of their own.  The search ends
when no interval reaches the k-th score found.  Documents are ordered by
length, longest first, so that an interval holds documents of like impacts.

All documents are read twice: for the collection's counts and the query
terms in each document, which are stored, and for the search.  Items are
taken in blocks of bounded size, each of them against all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillcast.llm.common import pick, ready, stored

TOP = 20
ITEM_BYTES = 4 << 20          # of item text in a block of items
BLOCK_POSTINGS = 250_000      # of a block of documents: its tables take about 150 bytes for each
BLOCK_ROWS = 256              # documents added to a block at once
WAVE = 64                     # intervals split at once
PIECE = 1 << 20               # bytes of a text taken apart at once
NO_ID = (1 << 63) - 1         # stands for a null id: last among ties

# Bytes that are part of a term, [0-9A-Za-z] and all of characters beyond ASCII.
_TERM_BYTES = bytes(b if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)).lower()


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in lists, each of a bounded piece of it."""
    flat, at = text.translate(_TERM_BYTES), 0
    while at < len(flat):
        end = len(flat) if len(flat) - at <= PIECE else flat.find(b" ", at + PIECE)
        end = len(flat) if end < 0 else end
        yield flat[at:end].split()
        at = end


def postings_of(vocabulary):
    """(doc_id, n, terms, tfs) of each document with a term; ``vocabulary`` is
    a broadcast dictionary of the query terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            ids, lengths, at, tfs = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                n, found = 0, Counter()
                for part in terms(text.as_py() or b""):
                    n += len(part)
                    found.update(filter(known.__contains__, part))
                if n:
                    ids.append(doc_id)
                    lengths.append(n)
                    at.append(np.fromiter(map(known.get, found), np.int32, len(found)).tobytes())
                    tfs.append(np.fromiter(found.values(), np.int32, len(found)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(at, pa.binary()), pa.array(tfs, pa.binary())],
                                             names=["doc_id", "n", "terms", "tfs"])
    return run


def holders(size: int):
    """Documents that hold each term, of one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.zeros(size, np.int64)
        for batch in batches:
            many += np.bincount(np.frombuffer(b"".join(batch.column("terms").to_pylist()), np.int32), minlength=size)
        hit = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(many[hit])], names=["term", "df"])
    return run


class Block:
    """Posting lists of some documents with their range-maximum tables."""

    def __init__(self, ids: np.ndarray, lengths: np.ndarray, term_parts: list[bytes], tf_parts: list[bytes],
                 weights: np.ndarray, docs: int, words: int):
        order = np.lexsort((ids, -lengths))
        self.ids, lengths = ids[order], lengths[order]
        self.size = len(ids)
        each = np.array([len(term_parts[i]) // 4 for i in order])
        term = np.frombuffer(b"".join(term_parts[i] for i in order), np.int32).astype(np.int64)
        tf = np.frombuffer(b"".join(tf_parts[i] for i in order), np.int32).astype(np.int64)
        doc = np.repeat(np.arange(self.size), each)
        m = 75 + 25 * lengths * docs // words
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
        by = np.argsort(term * self.size + doc)
        self.key, self.doc, self.impact = (term * self.size + doc)[by], doc[by], impact[by]
        self.start = np.searchsorted(self.key, np.arange(len(weights) + 1) * self.size)
        longest = int(np.diff(self.start).max(initial=1))
        self.top = argmax_table(self.impact, longest)
        self.low = argmax_table(-self.ids, self.size)
        self.log = np.r_[0, np.log2(np.arange(1, max(longest, self.size) + 2)).astype(np.int64)]

    def most(self, table: list[np.ndarray], value: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Index of the greatest value in each [a, b), for ranges that aren't empty."""
        level = self.log[b - a]
        left, right = np.empty_like(a), np.empty_like(a)
        for k in np.unique(level):
            at = level == k
            left[at], right[at] = table[k][a[at]], table[k][b[at] - (1 << k)]
        return np.where(value[left] >= value[right], left, right)

    def bounds(self, many: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the terms' range maxima in each interval, and the document of
        the greatest of them."""
        full = b > a
        where = np.zeros_like(a)
        where[full] = self.most(self.top, self.impact, a[full], b[full])
        part = np.where(full, self.impact[where] * many if len(self.impact) else 0, 0)
        first = part.argmax(1)
        return part.sum(1), self.doc[where[np.arange(len(a)), first]]

    def search(self, term: np.ndarray, many: np.ndarray, found: tuple[np.ndarray, np.ndarray], top: int) -> tuple[np.ndarray, np.ndarray]:
        """``found`` (scores and ids, best first) with this block's documents
        merged in: the ``top`` best of all."""
        scores, ids = found
        here = self.start[term + 1] > self.start[term]
        term, many = term[here], many[here]
        if not len(term):
            return found
        base = term * self.size
        a, b = self.start[term][None, :], self.start[term + 1][None, :]
        lo, hi = np.array([0]), np.array([self.size])
        bound, split = self.bounds(many, a, b)
        while True:
            if len(scores) == top:      # the k-th score is reached by a smaller id only
                hold = bound > scores[-1]
                tie = np.flatnonzero(bound == scores[-1])
                if len(tie):
                    hold[tie] = self.ids[self.most(self.low, -self.ids, lo[tie], hi[tie])] < ids[-1]
            else:
                hold = bound > 0
            if not hold.any():
                return scores, ids
            if not hold.all():
                a, b, lo, hi, bound, split = a[hold], b[hold], lo[hold], hi[hold], bound[hold], split[hold]
            go = np.argpartition(-bound, WAVE)[:WAVE] if len(bound) > WAVE else np.arange(len(bound))
            at = split[go]
            place = np.searchsorted(self.key, base[None, :] + at[:, None])
            hit = self.key[np.minimum(place, len(self.key) - 1)] == base[None, :] + at[:, None]
            score = np.where(hit, self.impact[np.minimum(place, len(self.key) - 1)] * many, 0).sum(1)
            scores, ids = np.r_[scores, score], np.r_[ids, self.ids[at]]
            best = np.lexsort((ids, -scores))[:top]
            scores, ids = scores[best], ids[best]
            a2, b2 = np.concatenate([a[go], place + hit]), np.concatenate([place, b[go]])
            lo2, hi2 = np.r_[lo[go], at + 1], np.r_[at, hi[go]]
            new = (b2 > a2).any(1)
            a2, b2, lo2, hi2 = a2[new], b2[new], lo2[new], hi2[new]
            bound2, split2 = self.bounds(many, a2, b2)
            rest = np.ones(len(bound), bool)
            rest[go] = False
            a, b = np.concatenate([a[rest], a2]), np.concatenate([b[rest], b2])
            lo, hi, bound, split = np.r_[lo[rest], lo2], np.r_[hi[rest], hi2], np.r_[bound[rest], bound2], np.r_[split[rest], split2]


def argmax_table(value: np.ndarray, longest: int) -> list[np.ndarray]:
    """Level k holds the index of the greatest value in each range of 2^k."""
    table = [np.arange(len(value), dtype=np.int32)]
    while 2 << len(table) - 1 <= min(longest, len(value)):
        half, last = 1 << len(table) - 1, table[-1]
        left, right = last[:-half], last[half:]
        table.append(np.where(value[left] >= value[right], left, right))
    return table


def searched(shared, top: int):
    """The best documents of each item (its number, doc_id, score), of one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights, docs, words = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]
        rows: list[tuple[np.ndarray, np.ndarray, list[bytes], list[bytes]]] = []
        held = 0

        def close() -> None:
            block = Block(np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]),
                          [t for r in rows for t in r[2]], [t for r in rows for t in r[3]], weights, docs, words)
            for i, (term, many) in enumerate(items):
                best[i] = block.search(term, many, best[i], top)

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):      # a batch can hold several blocks
                some = batch.slice(at, BLOCK_ROWS)
                part = some.column("terms").to_pylist()
                rows.append((some.column("doc_id").fill_null(NO_ID).to_numpy(), some.column("n").to_numpy(), part, some.column("tfs").to_pylist()))
                held += sum(map(len, part)) // 4
                if held >= BLOCK_POSTINGS:
                    close()
                    rows, held = [], 0
        if held:
            close()
        number = np.repeat(np.arange(len(items)), [len(s) for s, _ in best])
        ids = np.concatenate([np.zeros(0, np.int64), *[i for _, i in best]])
        yield pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array(ids, pa.int64(), mask=ids == NO_ID),
                                          pa.array(np.concatenate([np.zeros(0, np.int64), *[s for s, _ in best]]), pa.int64())], names=["item", "doc_id", "score"])
    return run


def item_blocks(items: DataFrame) -> Iterator[list[tuple[object, Counter]]]:
    """Items with the counts of their terms, in lists of bounded text; items
    without a term have no result and are left out."""
    held, size = [], 0
    for row in items.select("item_id", F.col("text").cast("string").cast("binary").alias("text")).toLocalIterator():
        many = Counter(t for part in terms(bytes(row.text or b"")) for t in part)
        if many:
            held.append((row.item_id, many))
            size += len(row.text)
        if size >= ITEM_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """For each row of ``items`` the ``top`` documents with the highest score
    above 0: item_id, rank (from 1), doc_id, score; equal scores stand by
    ascending doc_id, a null doc_id last.

    A null text has no term, and an item without a term no result.  Repeated
    documents stand beside each other, a repeated item is ranked each time.
    Without documents or items there are no rows.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    items = pick(items, item_id=item_col, text=item_text_col)
    kind = items.schema["item_id"].dataType
    parts = [_search_block(spark, rows, held, kind, top) for held in item_blocks(items)]
    if not parts:
        return spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _search_block(spark: SparkSession, rows: DataFrame, held: list, kind, top: int) -> DataFrame:
    sc = spark.sparkContext
    known = {t: i for i, t in enumerate(sorted({t for _, many in held for t in many}))}
    lists = stored(rows.mapInArrow(postings_of(sc.broadcast(known)), "doc_id long, n long, terms binary, tfs binary"), "postings")
    docs, words = lists.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(known), np.int64)      # as many numbers as the block has terms
    for r in lists.select("terms").mapInArrow(holders(len(known)), "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    wanted = [(np.array([known[t] for t in many], np.int64), np.array(list(many.values()), np.int64)) for _, many in held]
    found = lists.mapInArrow(searched(sc.broadcast((wanted, weights, docs, max(words, 1))), top), "item long, doc_id long, score long")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    # two levels, so that no task gets the candidates of an item from all tasks
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(32)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(held)], f"item long, item_id {kind.simpleString()}")
    return stored(ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked")
