"""Exact dedup with Patricia-trie owners.

Texts are equal when their bytes are, after all white space of
[\\x20\\x09-\\x0D] is deleted.  Each task puts its texts into a compressed
radix trie (below the content hash, so that unlike texts part at once)
whose terminal nodes hold the best row so far and a count.  That combines
copies before the shuffle: a text that a third of all rows share leaves
each task once.  The tries' entries go to partitions by length and content
hash, arrive sorted, and are inserted as full byte strings again.  A trie
over its memory limit spills by subtree: entries of finished subtrees go
out and their nodes are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import SPACE_BYTES, pick, ready

MEMORY_LIMIT = 48 << 20   # bytes of text that one task's trie may hold


class Patricia:
    """Radix trie over byte strings.  A node is [label, children by first
    byte, owner, count]; owner is None below a fork without an entry."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None, 0]
        self.bytes = 0

    def insert(self, key: bytes, owner: tuple, count: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, owner, count]
                self.bytes += len(key) - at + 300
                return
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = common_prefix(label, key[at:at + len(label)])
            fork = [label[:same], {label[same]: child}, None, 0]
            child[0] = label[same:]
            node[1][key[at]] = fork
            self.bytes += 300
            node, at = fork, at + same
        node[2] = owner if node[2] is None else min(node[2], owner)
        node[3] += count

    def entries(self, node: list | None = None, head: bytes = b"") -> Iterator[tuple]:
        """(key, owner, count) of a subtree, without recursion: tries of long
        texts can be deep."""
        stack = [(node or self.root, head)]
        while stack:
            top, before = stack.pop()
            key = before + top[0]
            if top[2] is not None:
                yield key, top[2], top[3]
            stack.extend((child, key) for child in top[1].values())

    def spill(self, but: int | None = None) -> Iterator[tuple]:
        """Entries of all subtrees below the root, except that of byte `but`;
        what went out is dropped."""
        kept = self.root[1].pop(but, None) if but is not None else None
        yield from self.entries()
        self.root = [b"", {}, None, 0]
        self.bytes = 0
        if kept is not None:
            self.root[1][but] = kept
            self.bytes = sum(len(k) for k, _, _ in self.entries())


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n   # a[:low] equals b[:low], a[:high] doesn't
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


def normal(text: bytes | None) -> bytes:
    return (text or b"").translate(None, SPACE_BYTES)


def owner_of(chars: int, ident: int | None) -> tuple:
    """Smallest wins: most code points, then smallest id, null ids last."""
    return (-chars, ident is None, ident or 0)


def _rows(entries: Iterator[tuple], schema: pa.Schema, full: bool) -> Iterator[pa.RecordBatch]:
    """Entries as batches of some MB: (length, hash, text) or (digest)."""
    rows: list[tuple] = []
    held = 0
    for key, (chars, no_id, ident), count in entries:
        text = key[8:]
        row = (-chars, None if no_id else ident, count)
        if full:
            row += (len(text), int.from_bytes(key[:8], "big") - (1 << 63), text)
            held += len(text)
        else:
            row += (hashlib.sha256(text).hexdigest(),)
        rows.append(row)
        held += 100
        if held > 4 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)
            rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema, strict=True)], schema=schema)


COMBINED = pa.schema([("chars", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("bytes", pa.int64()), ("hash", pa.int64()), ("text", pa.binary())])
OWNED = pa.schema([("keep_chars", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("sha", pa.string())])


def _combine(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Patricia()
        for batch in batches:
            ids, chars, texts = (batch.column(i).to_pylist() for i in range(3))
            for ident, n, text in zip(ids, chars, texts, strict=True):
                body = normal(text)
                trie.insert(xxhash.xxh64_digest(body) + body, owner_of(n, ident), 1)
                if trie.bytes > limit:
                    yield from _rows(trie.spill(), COMBINED, True)
        yield from _rows(trie.spill(), COMBINED, True)
    return run


def _own(limit: int):
    """Rows come sorted by length and hash.  One trie holds one length; the
    subtrees before the present hash are finished."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, length, last = Patricia(), -1, -1
        for batch in batches:
            cols = [batch.column(i).to_pylist() for i in range(6)]
            for chars, ident, n, size, h, text in zip(*cols, strict=True):
                if size != length or (h != last and trie.bytes > limit):
                    yield from _rows(trie.spill(), OWNED, False)
                    length = size
                last = h
                trie.insert((h + (1 << 63)).to_bytes(8, "big") + text, owner_of(chars, ident), n)
        yield from _rows(trie.spill(), OWNED, False)
    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sha = pa.array([hashlib.sha256(normal(t)).hexdigest() for t in batch.column(2).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sha], names=["doc_id", "chars", "sha"])


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                memory_limit: int = MEMORY_LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; texts of white space only are equal to it.
    Of equal texts the row with the most code points stays, then the one
    with the smallest id, null ids last.  Rows that tie in both (the same
    id repeated) are all kept, and each counts in group_size.  An empty
    table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars"),
        F.col("text").cast("string").cast("binary").alias("text"))
    combined = rows.mapInArrow(_combine(memory_limit), "chars long, doc_id long, n long, bytes long, hash long, text binary")
    owners = (combined.repartition("bytes", "hash").sortWithinPartitions("bytes", "hash")
              .mapInArrow(_own(memory_limit), "keep_chars long, keep_id long, group_size long, sha string")
              .filter("group_size > 1"))
    each = rows.mapInArrow(_digests, "doc_id long, chars long, sha string")
    joined = each.join(owners, "sha", "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars")))).alias("kept"),
        F.col("sha").alias("text_sha256"))
