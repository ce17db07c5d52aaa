"""Quality by perplexity under an interpolated modified Kneser-Ney model.

A model of character n-grams (ORDER characters) for each language is counted
over all trusted text.  Counts, continuation counts, discounts (three for
each order) and the interpolated probabilities are joins and aggregations
over the table of n-grams.

Documents are scored by joins that are sharded by n-gram.  Texts go to
blocks of about BLOCK_CHARS characters by a hash.  A block asks for each of
its distinct n-grams once: its questions go, packed, to the shards that
hold the model's entries for these n-grams and their shorter forms, and the
log probabilities come back to the block, where texts add theirs up.  So
what is shuffled is the compressed text once, and a few bytes for each
distinct n-gram of a block, not a row for each n-gram of a text.

A text is kept if its perplexity is no higher than that of all but the
worst 1 - QUANTILE of the trusted texts of its language that the model hasn't
seen: one in HELD_OUT of them, by a hash, isn't counted but sets the
threshold, since seen texts are less perplexing than new ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import numbered, place, ready, stored

ORDER = 5
QUANTILE = 0.98
BLOCK_CHARS = 4 << 20
SHARD_BLOCKS = 4         # blocks for each shard of the model
HELD_OUT = 8
STEPS = 1000             # of a nat of log perplexity: the quantiles' resolution
BEGIN = "\x02"           # ORDER - 1 of them stand before each text
TABLE = 1 << 23          # n-gram codes up to which a table finds the distinct ones, else sorting

ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_key(chars: np.ndarray, tag: int) -> np.ndarray:
    """64 bits for n-grams (rows of code points); tag tells languages and the
    two kinds of entry (probability, weight of a context) apart."""
    h = np.full(len(chars), np.uint64((tag * 2 + 1) % (1 << 64)), np.uint64)
    for k in range(chars.shape[1]):
        h = mixed((h ^ chars[:, k].astype(np.uint64)) * ODD + np.uint64(chars.shape[1]))
    return h


def tag_of(lang: str, kind: int) -> int:
    return xxhash.xxh64_intdigest(f"{kind} {lang}".encode())


def shard_of(third: np.ndarray, second: np.ndarray, shards: int) -> np.ndarray:
    """By the two characters before the last: n-grams, their suffixes of three
    characters or more, and the contexts of these lie together."""
    return (mixed((third.astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)


def distinct(code: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """Rank of each code among the distinct ones, and their number."""
    if size <= TABLE:
        seen = np.zeros(size, bool)
        seen[code] = True
        rank = np.cumsum(seen, dtype=np.int32)
        return rank[code] - 1, int(rank[-1]) if size else 0
    values, rank = np.unique(code, return_inverse=True)
    return rank.astype(np.int32), len(values)


class Grams:
    """The n-grams of a list of texts in one language, one for each character."""

    def __init__(self, texts: list[str]) -> None:
        pad = BEGIN * (ORDER - 1)
        flat = np.frombuffer("".join(pad + t for t in texts).encode("utf-32-le"), np.uint32)
        char, points = distinct(flat, int(flat.max()) + 1 if len(flat) else 0)
        size = np.array([len(t) + ORDER - 1 for t in texts], np.int64)
        self.first = np.cumsum(size) - size
        self.size = size - (ORDER - 1)
        char = char.astype(np.int64)
        rank, many = char, points
        for k in range(1, ORDER):
            rank, many = distinct(rank[:len(flat) - k].astype(np.int64) * points + char[k:], many * points) if len(flat) > k else (np.zeros(0, np.int32), 0)
        inside = np.ones(len(flat), bool)   # positions whose ORDER characters end in a character of a text
        for k in range(ORDER - 1):
            inside[self.first + k] = False
        self.rank = np.full(len(flat), -1, np.int32)
        self.rank[ORDER - 1:] = rank
        self.rank[~inside] = -1
        used = np.zeros(many, bool)
        used[self.rank[inside]] = True
        at = np.zeros(many, np.int64)
        at[self.rank[inside]] = np.flatnonzero(inside)
        new = np.cumsum(used) - 1
        self.rank[inside] = new[self.rank[inside]]
        at = at[used]
        self.chars = flat[at[:, None] + np.arange(1 - ORDER, 1)[None, :]] if len(at) else np.zeros((0, ORDER), np.uint32)

    def counts(self) -> np.ndarray:
        return np.bincount(self.rank[self.rank >= 0], minlength=len(self.chars))

    def sums(self, value: np.ndarray) -> np.ndarray:
        """Of each text's n-grams."""
        per = np.zeros(len(self.rank) + 1)
        per[:-1] = np.where(self.rank >= 0, value[self.rank] if len(value) else 0.0, 0.0)
        out = np.zeros(len(self.size))
        some = np.flatnonzero(self.size > 0)
        if len(some):
            a = self.first[some] + ORDER - 1
            out[some] = np.add.reduceat(per, np.c_[a, a + self.size[some]].ravel())[::2]
        return out


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, n-gram, count), once for each block of a task's texts."""
    held: dict[str, list[str]] = {}
    chars = 0

    def out() -> Iterator[pa.RecordBatch]:
        for lang, texts in sorted(held.items()):
            g = Grams(texts)
            whole = np.ascontiguousarray(g.chars).tobytes().decode("utf-32-le", "replace")
            for a in range(0, len(g.chars), 50_000):
                b = min(len(g.chars), a + 50_000)
                grams = [whole[ORDER * i:ORDER * i + ORDER] for i in range(a, b)]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (b - a)), pa.array(grams, pa.string()), pa.array(g.counts()[a:b], pa.int64())], names=["lang", "gram", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            chars += len(text)
            if chars > BLOCK_CHARS:
                yield from out()
                held, chars = {}, 0
    yield from out()


def fit(trusted: DataFrame) -> DataFrame:
    """(lang, text) of trusted text to the model (lang, gram, kind, value): kind
    0 has the log probability of the last character of gram after the
    others, kind 1 the log weight that a context leaves to shorter ones."""
    full = stored(trusted.mapInArrow(_counting, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    levels = {ORDER: full}
    for k in range(ORDER - 1, 0, -1):   # continuation counts: distinct characters before
        levels[k] = levels[k + 1].groupBy("lang", F.substring("gram", 2, k).alias("gram")).agg(F.count("*").alias("n"))
    table = levels[ORDER].withColumn("k", F.lit(ORDER))
    for k in range(ORDER - 1, 0, -1):
        table = table.union(levels[k].withColumn("k", F.lit(k)))
    table = stored(table, "counts")
    few = [F.sum((F.col("n") == i).cast("long")).alias(f"n{i}") for i in (1, 2, 3, 4)]
    of = table.groupBy("lang", "k").agg(*few)
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    cut = [F.least(F.greatest(F.coalesce(i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}")), F.lit(0.5 * i)), F.lit(0.1)), F.lit(0.95 * i)) for i in (1, 2, 3)]
    of = stored(of.select("lang", "k", *[c.alias(f"d{i + 1}") for i, c in enumerate(cut)]), "discounts")
    cut_of = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = table.join(of, ["lang", "k"]).withColumn("cut", cut_of).withColumn("context", F.expr("substring(gram, 1, k - 1)"))
    contexts = stored(rows.groupBy("lang", "k", "context").agg(F.sum("n").alias("total"), F.sum("cut").alias("left")), "contexts")
    rows = rows.join(contexts.drop("left"), ["lang", "k", "context"]).withColumn("own", (F.col("n") - F.col("cut")) / F.col("total"))
    rows = stored(rows.join(contexts.select("lang", "k", "context", (F.col("left") / F.col("total")).alias("weight")), ["lang", "k", "context"])
                  .select("lang", "k", "gram", "own", "weight"), "own")
    # and one for all characters that it lacks
    size = stored(table.filter("k = 1").groupBy("lang").agg(F.count("*").alias("v")), "sizes")
    p = (rows.filter("k = 1").join(size, "lang")
         .select("lang", "gram", (F.col("own") + F.col("weight") / (F.col("v") + 1)).alias("p")))
    probs = p
    for k in range(2, ORDER + 1):
        shorter = stored(p, f"p{k - 1}").select("lang", F.col("gram").alias("suffix"), F.col("p").alias("lower"))
        p = (rows.filter(F.col("k") == k).withColumn("suffix", F.substring("gram", 2, k - 1)).join(shorter, ["lang", "suffix"])
             .select("lang", "gram", (F.col("own") + F.col("weight") * F.col("lower")).alias("p")))
        probs = probs.union(p)
    weights = contexts.select("lang", F.col("context").alias("gram"), F.lit(1).alias("kind"), F.log(F.col("left") / F.col("total")).alias("value"))
    floor = contexts.filter("k = 1").join(size, "lang").select(   # an unknown character
        "lang", F.lit("").alias("gram"), F.lit(0).alias("kind"), F.log(1 / (F.col("v") + 1)).alias("value"))
    return stored(probs.select("lang", "gram", F.lit(0).alias("kind"), F.log("p").alias("value")).union(weights).union(floor), "model")


def _entries(shards: int):
    """Model rows with their key, and shard (-1: every shard has them)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike: dict[tuple[str, int, int], tuple[list[str], list[float]]] = {}
            for lang, gram, kind, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams, values = alike.setdefault((lang, kind, len(gram)), ([], []))
                grams.append(gram)
                values.append(value)
            parts = []
            for (lang, kind, size), (grams, values) in alike.items():
                chars = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(len(grams), size)
                last = size - 1 if kind == 0 else size   # characters before the one that is asked for
                shard = shard_of(chars[:, last - 2], chars[:, last - 1], shards) if last >= 2 else np.full(len(grams), -1)
                parts.append((shard, gram_key(chars, tag_of(lang, kind)).view(np.int64), np.array(values)))
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=["shard", "key", "value"])
    return run


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, id, lang, mark, text) to (block, lang, compressed ids, marks and texts)."""
    packer = zstandard.ZstdCompressor(level=5)
    held: dict[tuple[int, str], tuple[list, list, list]] = {}
    chars = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (block, lang), (ids, marks, texts) in sorted(held.items()):
            data = [t.encode() for t in texts]
            head = np.array([len(data), *map(len, data), *marks, *(i is None for i in ids), *(i or 0 for i in ids)], np.int64).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([lang]), pa.array([packer.compress(head + b"".join(data))], pa.binary())], names=["block", "lang", "data"])

    for batch in batches:
        for block, ident, lang, mark, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            ids, marks, texts = held.setdefault((block, lang), ([], [], []))
            ids.append(ident)
            marks.append(mark)
            texts.append(text)
            chars += len(text)
            if chars > 8 * BLOCK_CHARS:
                yield from out()
                held, chars = {}, 0
    yield from out()


def unpacked(chunks: pa.Table) -> dict[str, tuple[list[int | None], list[int], list[str]]]:
    """Ids, marks and texts of a block by language, in an order of their own."""
    found: dict[str, tuple[list, list, list]] = {}
    reader = zstandard.ZstdDecompressor()
    for lang, data in sorted(zip(chunks.column("lang").to_pylist(), chunks.column("data").to_pylist(), strict=True)):
        raw = reader.decompress(data)
        n = int(np.frombuffer(raw[:8], np.int64)[0])
        size, mark, none, ident = np.frombuffer(raw[8:8 + 32 * n], np.int64).reshape(4, n).tolist()
        body, at = raw[8 + 32 * n:], 0
        ids, marks, texts = found.setdefault(lang, ([], [], []))
        for k in size:
            texts.append(body[at:at + k].decode())
            at += k
        marks += mark
        ids += [None if no else i for no, i in zip(none, ident, strict=True)]
    return found


def in_order(shard: np.ndarray, shards: int) -> list[np.ndarray]:
    order = np.argsort(shard, kind="stable")
    return np.split(order, np.searchsorted(shard[order], np.arange(1, shards)))


ASK = pa.schema([("shard", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("key", pa.int64()), ("value", pa.float64()), ("data", pa.binary())])


def _asking(shards: int):
    """A block's distinct n-grams, packed by language and shard."""
    def run(chunks: pa.Table) -> pa.Table:
        block = chunks.column("block")[0].as_py()
        packer = zstandard.ZstdCompressor(level=6)
        rows = []
        for lang, (_, _, texts) in sorted(unpacked(chunks).items()):
            chars = Grams(texts).chars
            for shard, mine in enumerate(in_order(shard_of(chars[:, ORDER - 3], chars[:, ORDER - 2], shards), shards)):
                if len(mine):
                    rows.append({"shard": shard, "kind": 1, "block": block, "lang": lang, "data": packer.compress(np.ascontiguousarray(chars[mine].T).tobytes())})
        return pa.Table.from_pylist(rows, ASK)
    return run


def look_up(chars: np.ndarray, lang: str, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Log probability of each n-gram: of the longest form that the model has,
    plus the weights of the longer contexts that it has; nan without a model
    of the language."""
    def find(part: np.ndarray, kind: int) -> np.ndarray:
        key = gram_key(part, tag_of(lang, kind)).view(np.int64)
        at = np.searchsorted(keys, key)
        at[at == len(keys)] = 0
        return np.where(keys[at] == key, values[at], np.nan) if len(keys) else np.full(len(key), np.nan)

    out, weight, todo = np.full(len(chars), np.nan), np.zeros(len(chars)), np.arange(len(chars))
    for k in range(ORDER, -1, -1):
        part = chars[todo]
        p = find(part[:, ORDER - k:], 0)
        hit = ~np.isnan(p)
        out[todo[hit]] = weight[todo[hit]] + p[hit]
        todo, part = todo[~hit], part[~hit]
        if k and len(todo):
            weight[todo] += np.nan_to_num(find(part[:, ORDER - k:ORDER - 1], 1))
    return out


ANSWER = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("shard", pa.int64()), ("answer", pa.binary())])


def _answering(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and kind: a shard's model, then the questions to it."""
    reader = zstandard.ZstdDecompressor()
    now, parts, model = None, [], None
    for batch in batches:
        shard, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cut = np.flatnonzero(np.r_[True, (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])])
        for a, b in zip(cut.tolist(), np.r_[cut[1:], len(shard)].tolist(), strict=True):
            if shard[a] != now:
                now, parts, model = shard[a], [], None
            if kind[a] == 0:
                parts.append((batch.column(4).slice(a, b - a).to_numpy(), batch.column(5).slice(a, b - a).to_numpy()))
                continue
            if model is None:
                keys, values = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int64), np.zeros(0))
                order = np.argsort(keys)
                model, parts = (keys[order], values[order]), []
            rows = []
            for i in range(a, b):
                chars = np.frombuffer(reader.decompress(batch.column(6)[i].as_py()), np.uint32).reshape(ORDER, -1).T
                lang = batch.column(3)[i].as_py()
                rows.append({"block": batch.column(2)[i].as_py(), "lang": lang, "shard": int(now), "answer": look_up(chars, lang, *model).astype(np.float32).tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=ANSWER)


SCORE = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("mark", pa.int32()), ("chars", pa.int64()), ("log_p", pa.float64())])


def _scoring(shards: int):
    def run(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        told = {(r["lang"], r["shard"]): np.frombuffer(r["answer"], np.float32) for r in answers.to_pylist()}
        cols: list[list] = [[], [], [], [], []]
        for lang, (ids, marks, texts) in sorted(unpacked(chunks).items()):
            g = Grams(texts)
            value = np.full(len(g.chars), np.nan)
            for shard, mine in enumerate(in_order(shard_of(g.chars[:, ORDER - 3], g.chars[:, ORDER - 2], shards), shards)):
                if len(mine):
                    value[mine] = told[lang, shard]
            for col, part in zip(cols, (ids, [lang] * len(ids), marks, g.size.tolist(), g.sums(value).tolist()), strict=True):
                col.extend(part)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(cols, SCORE, strict=True)], schema=SCORE)
    return run


def perplexities(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, lang, mark, text) to (doc_id, lang, mark, chars, log_p), in
    nats; log_p is nan for languages without a model."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_CHARS))
    shards = max(1, -(-blocks // SHARD_BLOCKS))
    chunks = (docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"), "doc_id", "lang", "mark", "text")
              .mapInArrow(_chunks, "block long, lang string, data binary"))
    asked = chunks.groupBy("block").applyInArrow(_asking(shards), "shard long, kind int, block long, lang string, key long, value double, data binary")
    entries = stored(model.select("lang", "gram", "kind", "value").mapInArrow(_entries(shards), "shard long, key long, value double"), "entries")
    every = F.when(F.col("shard") < 0, F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).otherwise(F.array("shard"))
    entries = entries.select(F.explode(every).alias("shard"), F.lit(0).alias("kind"), F.lit(None).cast("long").alias("block"), F.lit(None).cast("string").alias("lang"),
                             "key", "value", F.lit(None).cast("binary").alias("data"))
    answers = (entries.union(asked).repartition("shard").sortWithinPartitions("shard", "kind")
               .mapInArrow(_answering, "block long, lang string, shard long, answer binary"))
    return (chunks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(_scoring(shards), "doc_id long, lang string, mark int, chars long, log_p double"))


def held_out() -> Column:
    """Which of the trusted texts (doc_id, text) set the threshold."""
    return F.pmod(F.xxhash64(F.lit("held out"), "doc_id", "text"), F.lit(HELD_OUT)) == 0


def kneser_ney_quality(docs: DataFrame, trusted: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       quantile: float = QUANTILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, trusted, n_chars, perplexity (by
    character), threshold, kept.

    trusted: a condition over the columns of ``docs``; a null is false.  Null
    language is the language ''.  Null and empty texts have no perplexity
    and are not kept.  A language without trusted text has no model, one
    without held-out trusted text no threshold: its texts are kept, since
    nothing speaks against them.  Repeated rows are scored each and count
    apiece.  An empty table gives no rows.
    """
    ready(docs.sparkSession)
    flat = numbered(docs.select("*", F.coalesce(trusted, F.lit(False)).alias("trusted text")))
    col = lambda c: F.col(f"c{place(docs, c)}")
    rows = flat.select(col(id_col).cast("long").alias("doc_id"), F.coalesce(col(lang_col).cast("string"), F.lit("")).alias("lang"),
                       F.col(f"c{len(docs.columns)}").alias("trusted"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    # 0 isn't trusted, 1 is counted, 2 is held out
    rows = rows.withColumn("mark", F.when(~F.col("trusted"), 0).when(held_out(), 2).otherwise(1)).drop("trusted")
    model = fit(rows.filter("mark = 1 AND text <> ''").select("lang", "text"))
    cost = F.when((F.col("chars") > 0) & ~F.isnan("log_p"), -F.col("log_p") / F.col("chars"))
    scored = stored(perplexities(rows, model).withColumn("cost", cost).withColumn("step", F.floor(F.col("cost") * STEPS)), "scores")
    steps = scored.filter("mark = 2 AND step IS NOT NULL").groupBy("lang", "step").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy("step"))
    most = F.sum("n").over(Window.partitionBy("lang"))
    limit = stored(steps.withColumn("upto", upto).withColumn("all", most).filter(F.col("upto") >= quantile * F.col("all"))
                   .groupBy("lang").agg(F.min("step").alias("limit")), "limits")
    out = scored.join(limit, "lang", "left")
    none = F.col("limit").isNull()
    return out.select("doc_id", "lang", (F.col("mark") > 0).alias("trusted"), F.col("chars").alias("n_chars"), F.round(F.exp("cost"), 6).alias("perplexity"),
                      F.round(F.exp((F.col("limit") + 1) / STEPS), 6).alias("threshold"),
                      ((F.col("chars") > 0) & (none | F.coalesce(F.col("step") <= F.col("limit"), F.lit(False)))).alias("kept"))
