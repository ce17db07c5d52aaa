"""BPE encoding and decoding by batched numpy merge rounds.

The distinct words of a batch of texts become one flat array of symbol
ids.  A round looks all neighbouring pairs up by binary search in the
sorted pair keys of the merge table, takes for every word its pair of
lowest rank, and merges all of its occurrences that don't overlap.  Rounds
end when no word has a pair left.  Ids of the words are then dealt out to
the texts with one ragged gather.

The vocabulary is a file of the tokenizers library (model BPE with a word
end; normalised by NFC, runs of white space to one space, lower case).  It
is read on the driver and broadcast: its size doesn't depend on the data.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import numbered, place, ready

CACHE_WORDS = 200_000   # words a Python worker remembers between batches
CHUNK_CHARS = 1 << 20   # texts are encoded in chunks of about this size

# The normaliser and pre-tokenizer of the vocabulary file.
WHITE = r"\p{White_Space}+"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE:
    printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = {b for low, high in (("!", "~"), ("\xa1", "\xac"), ("\xae", "\xff")) for b in range(ord(low), ord(high) + 1)}
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class Vocabulary:
    """Merge table and tokens as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder") is not None:
            raise ValueError("a BPE vocabulary without a decoder is expected")
        ids: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        everything = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [everything.get(i) for i in range(max(everything) + 1)]
        symbols = byte_symbols()
        self.inner = np.array([ids[s] for s in symbols], np.int64)
        self.last = np.array([ids[s + end] for s in symbols], np.int64)
        pairs = [(ids[a], ids[b], rank, ids[a + b]) for rank, (a, b) in enumerate(model["merges"])]
        left, right, rank, made = (np.array(x, np.int64) for x in zip(*pairs, strict=True))
        keys = (left << 32) | right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], rank[order], made[order]


class Coder:
    """Encodes and decodes lists of texts with one vocabulary."""

    def __init__(self, vocab: Vocabulary) -> None:
        self.vocab = vocab
        self.white, self.pieces = regex.compile(WHITE), regex.compile(PIECES)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, vocab.special)) + ")") if vocab.special else None
        self._forget()

    def _forget(self) -> None:
        """Word numbers 0, 1, ... are special tokens, then words as they come."""
        self.known: dict[str, int] = {}
        self.flat = np.array(list(self.vocab.special.values()), np.int32)
        self.starts = np.arange(len(self.vocab.special) + 1, dtype=np.int64)
        self.mark_no = {t: i for i, t in enumerate(self.vocab.special)}

    def _words(self, text: str) -> list[str]:
        text = self.white.sub(" ", unicodedata.normalize("NFC", text))
        # lower case character by character: a final sigma is no special case
        return self.pieces.findall(text.replace("Σ", "σ").lower())

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and each word's start (one more than words)."""
        v = self.vocab
        data = [w.encode() for w in words]
        size = np.array([len(d) for d in data], np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        ends = np.cumsum(size)
        ids = v.inner[raw]
        ids[ends - 1] = v.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        done_ids, done_word = [], []
        while len(ids):
            pair = (ids[:-1] << 32) | ids[1:]
            at = np.searchsorted(v.keys, pair)
            at[at == len(v.keys)] = 0
            fits = (v.keys[at] == pair) & (word[:-1] == word[1:])
            rank = np.where(fits, v.ranks[at], np.int64(1) << 40)
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(np.r_[rank, np.int64(1) << 40], first)
            length = np.diff(np.r_[first, len(ids)])
            low = np.repeat(low, length)
            open_ = low < (np.int64(1) << 40)
            if not open_.all():   # words without a pair leave the rounds
                done_ids.append(ids[~open_])
                done_word.append(word[~open_])
            hit = np.r_[(rank == low[:-1]) & open_[:-1], False]
            # in a run of overlapping hits (one symbol repeated) every other one merges
            spot = np.flatnonzero(hit)
            if len(spot):
                new_run = np.r_[True, (np.diff(spot) != 1) | (rank[spot[1:]] != rank[spot[:-1]])]
                run_at = np.maximum.accumulate(np.where(new_run, np.arange(len(spot)), 0))
                spot = spot[(np.arange(len(spot)) - run_at) % 2 == 0]
                ids[spot] = v.made[at[spot]]
                open_[spot + 1] = False
            ids, word = ids[open_], word[open_]
        if not done_ids:
            return np.empty(0, np.int32), np.zeros(1, np.int64)
        flat, word = np.concatenate(done_ids), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        starts = np.r_[0, np.cumsum(np.bincount(word, minlength=len(words)))]
        return flat[order].astype(np.int32), starts

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and each text's start; null is empty."""
        if len(self.known) > CACHE_WORDS:
            self._forget()
        fresh: list[str] = []
        known, base = self.known, len(self.starts) - 1
        numbers: list[int] = []
        count = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            before = len(numbers)
            parts = self.marks.split(text or "") if self.marks else [text or ""]
            for k, part in enumerate(parts):
                if k % 2:
                    numbers.append(self.mark_no[part])
                    continue
                for w in self._words(part):
                    n = known.get(w)
                    if n is None:
                        n = known[w] = base + len(fresh)
                        fresh.append(w)
                    numbers.append(n)
            count[i] = len(numbers) - before
        if fresh:
            flat, starts = self.merge(fresh)
            self.flat, self.starts = np.concatenate([self.flat, flat]), np.concatenate([self.starts, starts[1:] + self.starts[-1]])
        which = np.array(numbers, np.int64)
        size = self.starts[which + 1] - self.starts[which]
        ends = np.r_[0, np.cumsum(size)]
        gather = np.arange(ends[-1]) + np.repeat(self.starts[which] - ends[:-1], size)
        return self.flat[gather], ends[np.r_[0, np.cumsum(count)]]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """Tokens joined by one space: what a vocabulary without a decoder gives."""
        tokens = self.vocab.tokens
        every = ids.tolist()
        return [" ".join([t for i in every[a:b] if (t := tokens[i]) is not None]) for a, b in zip(starts[:-1], starts[1:], strict=True)]


def chunks(texts: list[str | None], limit: int = CHUNK_CHARS) -> Iterator[list[str | None]]:
    part, held = [], 0
    for t in texts:
        part.append(t)
        held += len(t or "")
        if held > limit:
            yield part
            part, held = [], 0
    if part:
        yield part


def _coding(shared, decode: bool, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            done = 0
            for part in chunks(batch.column(text_at).to_pylist()):
                ids, starts = coder.encode(part)
                kept = batch.slice(done, len(part))
                done += len(part)
                cols = [*kept.columns, pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(ids, pa.int32()))]
                if decode:
                    cols.append(pa.array(coder.decode(ids, starts), pa.string()))
                names = [*kept.schema.names, "ids", "decoded"][:len(cols)]
                yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def bpe_encode(docs: DataFrame, vocabulary: str, text_col: str = "text", ids_col: str = "ids",
               decoded_col: str | None = None) -> DataFrame:
    """``docs`` with the token ids of each whole text (array<int>) and, if
    ``decoded_col`` is named, the text decoded from these ids.

    Null and empty texts have no ids and decode to the empty text.  Special
    tokens that stand in a text are encoded as such; none are added.  All
    rows and columns stay, repeated ones too; a new column replaces one of
    the same name.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(vocabulary))
    flat = numbered(docs)
    at = place(docs, text_col)
    flat = flat.withColumn(f"c{at}", F.col(f"c{at}").cast("string"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in flat.schema.fields)
    done = flat.mapInArrow(_coding(shared, decoded_col is not None, at),
                           f"{fields}, ids array<int>" + (", decoded string" if decoded_col else ""))
    new = {ids_col.lower(): ("ids", ids_col)} | ({decoded_col.lower(): ("decoded", decoded_col)} if decoded_col else {})
    keep = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in new]
    return done.select(*keep, *[F.col(a).alias(b) for a, b in new.values()])


def _decoding(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                part = batch.slice(row, 500)
                lists = [np.array(x or [], np.int32) for x in part.column(part.num_columns - 1).to_pylist()]
                starts = np.r_[0, np.cumsum([len(x) for x in lists])]
                text = coder.decode(np.concatenate(lists) if lists else np.empty(0, np.int32), starts)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(text, pa.string())], names=[*part.schema.names[:-1], "decoded"])
    return run


def bpe_decode(rows: DataFrame, vocabulary: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``rows`` with the ids of ``ids_col`` decoded; null and empty lists give
    the empty text, ids outside the vocabulary are left out."""
    spark = rows.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(Vocabulary(vocabulary))
    size = len(shared.value.tokens)
    flat = numbered(rows)
    at = f"c{place(rows, ids_col)}"
    flat = flat.withColumn("ids", F.filter(F.coalesce(F.col(at), F.array().cast("array<int>")), lambda i: (i >= 0) & (i < size)))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in flat.schema.fields[:-1])
    done = flat.mapInArrow(_decoding(shared), f"{fields}, decoded string")
    keep = [F.col(f"c{i}").alias(c) for i, c in enumerate(rows.columns) if c.lower() != decoded_col.lower()]
    return done.select(*keep, F.col("decoded").alias(decoded_col))


def bpe_digest(encoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of an encoded table, and the
    columns of ``more``."""
    return encoded.select(
        "doc_id", *more, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
