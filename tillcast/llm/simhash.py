"""SimHash near-dedup by anchor-point covering.

Fingerprints of 64 bits link when at most D = 4 bits differ.  The bits are
three blocks; of the three pairs of blocks one differs in t = 2 bits at most,
for the block with most of the differing bits has two or more of the four.
On each pair of blocks the anchors are the pairs of codewords of the binary
Golay code [23, 12], which covers each block (padded with zeros) with radius
R = 3.

A fingerprint has one home anchor in each pair: the codewords next to its
blocks.  It is replicated to every anchor within covering radius plus
threshold: those whose distances from its blocks exceed R by no more than t
bits together.  Fingerprints x and y that differ in t bits of the pair meet
at the home of x: its codewords are within R of x, so within R plus the
differing bits of y.  Only homes are compared with replicas there.

Equal fingerprints are grouped first.  In a dense group of near copies most
pairs are left out as linked already: a fingerprint within D bits of the
least fingerprint at one of its homes is linked to that one alone, and two
with the same such hub aren't paired.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import numbered, pick, place, ready, stored
from tillcast.llm.components import components

WORDS = 4          # words of a shingle
MAX_BITS = 4       # differing bits of a link
SEED = 42

RADIUS, THRESHOLD = 3, 2
CUTS = ((0, 21), (21, 21), (42, 22))       # first bit and length of each block
PAIRS = ((0, 1), (0, 2), (1, 2))
GOLAY = 0b110001110101                     # generator polynomial of the code


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """Unsigned; zero for null and for text without a word."""
    parts = (text or b"").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    if len(parts) <= words:
        cuts = [(0, len(joined))]
    else:
        cuts = zip(np.r_[0, ends[:-words] + 1].tolist(), ends[words - 1:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in cuts], np.uint64)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 50_000):
        part = hashes[at:at + 50_000]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view(np.uint64)[0])


def remainder(x: np.ndarray) -> np.ndarray:
    """Of 23-bit polynomials, by the generator: the syndrome."""
    x = x.copy()
    for bit in range(22, 10, -1):
        x ^= np.where((x >> bit) & 1, GOLAY << (bit - 11), 0)
    return x


@cache
def neighbours() -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The least error of each syndrome; and for the excess 0, 1, 2 over the
    radius the messages of the codewords (relative to home) at that distance
    from it: flat, and each syndrome's start."""
    points = np.arange(1 << 23, dtype=np.int32)
    light = points[np.bitwise_count(points) <= RADIUS]
    error = np.zeros(1 << 11, np.int32)
    error[remainder(light)] = light
    message = np.arange(1 << 12, dtype=np.int32) << 11
    word = message ^ remainder(message)
    far = np.bitwise_count(error[:, None] ^ word[None, :]).astype(np.int16)
    lists = []
    for excess in range(THRESHOLD + 1):
        hit = far <= RADIUS if excess == 0 else far == RADIUS + excess
        row, col = np.nonzero(hit)
        lists.append((col.astype(np.int64), np.r_[0, np.cumsum(np.bincount(row, minlength=1 << 11))]))
    return error, lists


def block(prints: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Home message and syndrome of block k."""
    first, size = CUTS[k]
    x = ((prints >> np.uint64(first)) & np.uint64((1 << size) - 1)).astype(np.int32)
    s = remainder(x)
    return ((x ^ neighbours()[0][s]) >> 11).astype(np.int64), s


def home_anchors(prints: np.ndarray) -> np.ndarray:
    """Anchors by pair of blocks (rows) and fingerprint (columns)."""
    homes = [block(prints, k)[0] for k in range(3)]
    return np.stack([(np.int64(p) << 24) | (homes[a] << 12) | homes[b] for p, (a, b) in enumerate(PAIRS)])


def all_anchors(prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(anchor, index of the fingerprint) within covering radius plus threshold."""
    blocks = [block(prints, k) for k in range(3)]
    lists = neighbours()[1]
    for p, (a, b) in enumerate(PAIRS):
        for i in range(THRESHOLD + 1):
            for j in range(THRESHOLD + 1 - i):
                (flat_a, start_a), (flat_b, start_b) = lists[i], lists[j]
                (home_a, syn_a), (home_b, syn_b) = blocks[a], blocks[b]
                many_b = start_b[syn_b + 1] - start_b[syn_b]
                many = (start_a[syn_a + 1] - start_a[syn_a]) * many_b
                who = np.repeat(np.arange(len(prints)), many)
                at = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
                left = home_a[who] ^ flat_a[start_a[syn_a[who]] + at // many_b[who]]
                right = home_b[who] ^ flat_b[start_b[syn_b[who]] + at % many_b[who]]
                yield (np.int64(p) << 24) | (left << 12) | right, who


def _fingerprints(words: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(text_at)], np.uint64)
            cols = [c for i, c in enumerate(batch.columns) if i != text_at]
            names = [n for i, n in enumerate(batch.schema.names) if i != text_at]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(prints.view(np.int64))], names=[*names, "fp"])
    return run


def _homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column("fp").to_numpy().view(np.uint64)
        for anchors in home_anchors(prints):
            yield pa.RecordBatch.from_arrays([pa.array(anchors), *batch.columns], names=["anchor", *batch.schema.names])


def _replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(0, batch.num_rows, 2000):
            part = batch.slice(row, 2000)
            for anchors, who in all_anchors(part.column("fp").to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(anchors), *part.take(pa.array(who)).columns], names=["anchor", *part.schema.names])


def near(x: str, y: str, bits: int) -> F.Column:
    return F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= bits


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp), enough for their
    components: every link within ``max_bits`` stands, or its two ends stand
    linked to one hub."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"the anchors cover links of at most {MAX_BITS} bits")
    homes = prints.mapInArrow(_homes, "anchor long, fp long")
    least = homes.groupBy("anchor").agg(F.min("fp").alias("hub"))
    hub = F.when(near("fp", "hub", max_bits), F.col("hub")).otherwise(F.col("fp"))
    # Spark sizes what comes out of mapInArrow as the rows that go in, though each fingerprint has three homes
    # and some 190 replicas: without the hints it broadcasts them
    hubs = homes.hint("merge").join(least, "anchor").groupBy("fp").agg(F.min(hub).alias("hub"))
    hubs = stored(hubs, "hubs")
    x = hubs.mapInArrow(_homes, "anchor long, fp long, hub long")
    y = hubs.mapInArrow(_replicas, "anchor long, fp long, hub long")
    y = y.select("anchor", F.col("fp").alias("fp2"), F.col("hub").alias("hub2"))
    met = x.hint("merge").join(y, (x.anchor == y.anchor) & (x.hub != y.hub2) & near("fp", "fp2", max_bits))
    return (met.select(F.col("fp").alias("a"), F.col("fp2").alias("b"))
            .union(hubs.filter("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits),
    component_id (smallest doc_id that is reached over links).

    Null text, empty text and text without a word have fingerprint zero and
    link like any other.  Repeated rows share a component; a null id counts
    as none (a component without any id has a null component_id).  An empty
    table gives no rows.
    """
    ready(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    prints = stored(rows.mapInArrow(_fingerprints(words, 1), "doc_id long, fp long"), "fingerprints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    linked = components(links(classes.select("fp"), max_bits))
    member = classes.join(linked, classes.fp == linked.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    member = stored(member, "members")
    first = member.groupBy("root").agg(F.min("least").alias("component_id"))
    named = member.join(first, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest
    id.  All rows that repeat that id stay, and so do rows with a null id,
    which no link can name; all columns stay."""
    found = simhash_components(docs, id_col, text_col, words, max_bits)
    gone = stored(found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "dropped")
    flat, at = numbered(docs), f"c{place(docs, id_col)}"
    return flat.join(gone, F.col(at) == F.col("gone"), "left_anti").toDF(*docs.columns)
