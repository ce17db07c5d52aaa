"""Language ID by cross-parsing entropy.

For each language a suffix automaton holds all substrings of a sample of
its labelled text.  A document is parsed into phrases, each the longest
match in that automaton (a character that it doesn't hold is a phrase of
its own).  Phrases times log2 of the sample's length, by the document's
length, is the cross entropy of Ziv and Merhav; the language with the
least wins.

The sample is bounded (SAMPLE_CHARS characters, dealt out to the
languages), the automata therefore too, and they are broadcast.  Tasks walk
them as dense tables for thousands of text blocks at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import numbered, pick, place, ready
from tillcast.operators.joins import checked_broadcast

SAMPLE_CHARS = 256_000   # of labelled text, all languages together
SAMPLE_DOCS = 64         # labelled documents that a language's sample is drawn from, about
DOC_PART = 8             # a document is at most one part in so many of its language's sample
SYMBOLS = 250            # of the automata's alphabet, besides space, unknown and padding
BLOCK = 256              # characters that are parsed in one go
CHUNK = 1 << 19          # characters that a task walks at a time
NO_LANGUAGE = "und"

STATE_BITS = 28
MASK = (1 << STATE_BITS) - 1


def suffix_automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p >= 0:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(c) == q:
                    moves[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return moves


def walk_table(moves: list[dict[int, int]], width: int) -> np.ndarray:
    """One int per state and code: the next state times width, and above
    STATE_BITS the phrases that end here.  Code width - 1 is padding and
    changes nothing; code width - 2 is a letter that no sample has."""
    if len(moves) * width > MASK:
        raise ValueError("the sample is too long for its alphabet")
    table = np.zeros((len(moves), width), np.int32)
    begin = np.zeros(width, np.int32)
    known = np.zeros(width, bool)
    for c, s in moves[0].items():
        begin[c], known[c] = s * width, True
    # the phrase ends and the next one starts with this character, or the
    # character is a phrase of its own
    table[:] = np.where(known, begin | (1 << STATE_BITS), 2 << STATE_BITS)
    table[0] = np.where(known, begin, 1 << STATE_BITS)
    for s, go in enumerate(moves):
        for c, to in go.items():
            table[s, c] = to * width
    table[:, width - 1] = np.arange(len(moves)) * width
    return table.reshape(-1)


def letter(c: str) -> str | None:
    return c.lower()[0] if c.isalpha() else None


def plain(text: str) -> str:
    """Letters in lower case; every run of other characters is one space."""
    out: list[str] = []
    for c in text:
        a = letter(c) or " "
        if a != " " or (out and out[-1] != " "):
            out.append(a)
    return "".join(out)


class Parser:
    """Automata of all languages over one alphabet.

    A letter is one symbol as long as the samples have no more than SYMBOLS
    letters.  With more, a letter is written with two digits, or three, each
    from a share of the symbols of its own, so that the tables stay narrow
    and no two letters fall together."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.langs = sorted(samples)
        self.samples = {k: plain(samples[k]) for k in self.langs}
        chars = sorted(set("".join(self.samples.values())) - {" "})
        self.digits = next(d for d in (1, 2, 3, 4) if (SYMBOLS // d) ** d >= len(chars))
        base = SYMBOLS // self.digits if self.digits > 1 else len(chars)
        self.width = base * self.digits + 3   # space, symbols, unknown, padding
        unknown = self.width - 2
        self.code = {c: [1 + d * base + i // base ** d % base for d in range(self.digits)] if self.digits > 1 else [i + 1] for i, c in enumerate(chars)}
        symbols = {" ": [0]} | self.code
        self.tables = [walk_table(suffix_automaton([x for c in self.samples[k] for x in symbols[c]]), self.width) for k in self.langs]
        self.weight = np.array([np.log2(max(2, len(self.samples[k]))) for k in self.langs])
        self.codes = np.zeros((self.digits, 0x110000), np.uint8)   # first digit 0: no letter
        for point in range(0x110000):
            if (c := letter(chr(point))) is not None:
                digits = self.code.get(c, [unknown])
                self.codes[:len(digits), point] = digits

    def phrases(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases by language and text, and the characters parsed of each text
        (0 if it has no letter)."""
        sizes = np.array([len(t or "") for t in texts], np.int64)
        raw = np.frombuffer("".join(t or "" for t in texts).encode("utf-32-le", "replace"), np.uint32)
        codes = self.codes[0][raw]
        owner = np.repeat(np.arange(len(texts)), sizes)
        ends = np.cumsum(sizes)
        # a space stays if a letter of the same text stands before it
        before = np.r_[np.uint8(0), codes[:-1]]
        before[(ends - sizes)[sizes > 0]] = 0
        keep = (codes > 0) | (before > 0)
        has = np.bincount(owner[codes > 0], minlength=len(texts)) > 0
        codes, owner = codes[keep], owner[keep]
        chars = np.where(has, np.bincount(owner, minlength=len(texts)), 0)
        if self.digits > 1:
            raw = raw[keep]
            many = np.where((codes > 0) & (codes < self.width - 2), self.digits, 1)
            at = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            codes, owner = self.codes[at, np.repeat(raw, many)], np.repeat(owner, many)
        length = np.where(has, np.bincount(owner, minlength=len(texts)), 0)
        blocks = -(-length // BLOCK)
        first = np.r_[0, np.cumsum(blocks)]
        lanes = np.full((first[-1], BLOCK), self.width - 1, np.uint8)
        inside = np.arange(len(codes)) - np.repeat(np.r_[0, np.cumsum(length)[:-1]], length)
        lanes[first[owner] + inside // BLOCK, inside % BLOCK] = codes
        steps = np.ascontiguousarray(lanes.T)
        lane_owner = np.repeat(np.arange(len(texts)), blocks)
        counts = np.zeros((len(self.langs), len(texts)), np.int64)
        for k, table in enumerate(self.tables):
            state = np.zeros(len(lanes), np.int32)
            ended = np.zeros(len(lanes), np.int32)
            for row in steps:
                state += row
                state = table.take(state)
                ended += state >> STATE_BITS
                state &= MASK
            ended += state > 0
            counts[k] = np.bincount(lane_owner, ended, minlength=len(texts))
        return counts, chars

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        counts, length = self.phrases(texts)
        out: list[tuple[str, float]] = []
        for i, n in enumerate(length):
            if not n:
                out.append((NO_LANGUAGE, 0.0))
                continue
            cost = counts[:, i] * self.weight / n
            order = np.argsort(cost, kind="stable")
            rest = cost[order[1]] if len(order) > 1 else np.inf
            score = 1.0 if np.isinf(rest) else float(rest / (rest + cost[order[0]]))
            out.append((self.langs[order[0]], score))
        return out


def fit_parser(labelled: DataFrame, sample_chars: int = SAMPLE_CHARS, sample_docs: int = SAMPLE_DOCS) -> Parser | None:
    """From (doc_id, text, lang): documents in the order of a hash of doc_id,
    about ``sample_docs`` a language, until the language's share of
    ``sample_chars`` is full; of a document at most one part in DOC_PART of
    the share, so that no single one is a language's sample.  None if there
    is nothing to learn from.  Rows with null text, lang or doc_id teach
    nothing."""
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text", "lang")
    top = 1 << 30
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"))
    langs = counts.count()
    if not langs:
        return None
    order = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(top))
    share = max(1, sample_chars // langs)
    short = rows.select("doc_id", "lang", order.alias("at"), F.substring("text", 1, max(1, share // DOC_PART)).alias("text"))
    drawn = (short.join(checked_broadcast(counts, max_rows=langs), "lang").filter(F.col("at") <= F.least(F.lit(float(top)), F.lit(float(top * sample_docs)) / F.col("n")))
             .select("lang", "at", "doc_id", "text"))
    samples: dict[str, str] = {}
    for r in sorted(drawn.collect(), key=lambda r: (r.at, r.doc_id, r.text)):
        if len(samples.setdefault(r.lang, "")) < share:
            samples[r.lang] = (samples[r.lang] + "\n" + r.text)[:share]
    samples = {k: v for k, v in samples.items() if plain(v).strip()}
    return Parser(samples) if samples else None


def _predicting(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = shared.value
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            found: list[tuple[str, float]] = []
            part: list[str | None] = []
            held = 0
            for t in [*texts, None]:
                part.append(t)
                held += len(t or "")
                if held > CHUNK or len(found) + len(part) > len(texts):
                    found += parser.predict(part) if parser else [(NO_LANGUAGE, 0.0)] * len(part)
                    part, held = [], 0
            found = found[:len(texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])
    return run


def predict_language(rows: DataFrame, parser: Parser | None) -> DataFrame:
    """``rows`` (with a column text) plus lang_pred and score.

    lang_pred is ``und`` with score 0 for null text, text without a letter,
    and without a parser.  Score: cost of the second language over the sum
    of the two least costs, 0.5 for a draw (the first name wins); 1 if only
    one language was learned.
    """
    spark = rows.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(parser)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_predicting(shared, rows.columns.index("text")), f"{fields}, lang_pred string, score double")


def held_out(doc_id) -> F.Column:
    """Documents that are not learned from: crc32 of the id as text, mod 4, is
    2.  A null id is not held out (and not learned from either)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, learned
    from the rows that are not held out.  Repeated rows are predicted each;
    an empty table gives no rows."""
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    parser = fit_parser(rows.filter(~held_out("doc_id")))
    return predict_language(rows.select("doc_id", "text", held_out("doc_id").alias("held_out")), parser).drop("text")


def known_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text is in a language, with all columns:
    ``lang_col`` becomes the predicted language.  Rows with null text and
    texts without a letter go.  Where no row has a label to learn from,
    nothing is predicted: those rows go, the others stay as they are."""
    rows = pick(docs, doc_id=id_col, text=text_col, lang=lang_col)
    parser = fit_parser(rows.filter(~held_out("doc_id")))
    at, lang = f"c{place(docs, text_col)}", f"c{place(docs, lang_col)}"
    flat = numbered(docs)
    if parser is None:
        return flat.filter(F.col(at).rlike("\\p{L}")).toDF(*docs.columns)
    found = predict_language(flat.withColumnRenamed(at, "text"), parser).filter(F.col("lang_pred") != NO_LANGUAGE)
    kind = docs.schema[place(docs, lang_col)].dataType
    return found.withColumn(lang, F.col("lang_pred").cast(kind)).drop("lang_pred", "score").toDF(*docs.columns)
