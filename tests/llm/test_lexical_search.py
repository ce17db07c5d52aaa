import math
import random
import re
from collections import Counter

import numpy as np

from tillcast.llm import lexical_search as S

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]


def brute(docs, items, top=20):
    parts = [(i, Counter(split(t))) for i, t in docs]
    parts = [(i, c) for i, c in parts if c]
    many, words = len(parts), sum(sum(c.values()) for _, c in parts)
    df = Counter(t for _, c in parts for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in parts:
            m = 100 - 25 + (25 * sum(c.values()) * many) // words
            s = sum(math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in split(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i if i is not None else 0))
        out += [(item, r, None if no else i, -s) for r, (s, no, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, size):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["École", "straße", "A1b2", "日本", "x" * 400]
    text = lambda n: " ".join(rnd.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=n))
    docs = [(k, text(rnd.choice([1, 3, 20, 60, 60, 400]))) for k in range(size)]
    docs += [(size + k, docs[5][1]) for k in range(60)] + [(None, docs[7][1]), (9, docs[9][1]), (size + 100, None), (size + 101, ""), (size + 102, "-- \t!"),
                                                          (size + 103, "W1,w2;W3\n(w4)" * 50)]
    items = [(k, text(rnd.choice([1, 5, 40]))) for k in range(25)] + [(80, None), (81, "?!"), (82, "unknown words only"), (None, "w3 w3 w4"), (3, "w7"), (83, docs[5][1])]
    return docs, items


def test_against_brute_force(spark, monkeypatch):
    docs, items = corpus(2, 400)
    df = spark.createDataFrame([(*d, "k", 1) for d in docs], "doc_id long, text string, item_id string, n int").repartition(3)
    got = S.ranked_search(df, spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, rank int"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)
    monkeypatch.setattr(S, "ITEM_BYTES", 300)
    few = S.ranked_search(df, spark.createDataFrame(items[:9], "item_id long, text string"), top=3)
    assert sorted(map(tuple, few.collect()), key=str) == brute(docs, items[:9], 3)
    assert S.ranked_search(df.limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert S.ranked_search(df, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_range_maxima():
    rng = np.random.default_rng(1)
    block = S.Block.__new__(S.Block)
    value = rng.integers(0, 50, 300)
    table = S.argmax_table(value, 300)
    block.log = np.r_[0, np.log2(np.arange(1, 302)).astype(np.int64)]
    a = rng.integers(0, 299, 500)
    b = a + 1 + (rng.random(500) * (300 - a - 1)).astype(np.int64)
    got = block.most(table, value, a, b)
    assert all(a[k] <= got[k] < b[k] and value[got[k]] == value[a[k]:b[k]].max() for k in range(500))


def test_search_leaves_documents_unopened():
    """Intervals below the k-th score are never split."""
    rng = np.random.default_rng(3)
    size, terms = 4000, 40
    lengths = rng.integers(5, 3000, size)
    held = [np.unique(rng.integers(0, terms, max(1, n // 60))).astype(np.int32) for n in lengths]
    block = S.Block(np.arange(size), lengths, [h.tobytes() for h in held], [np.ones(len(h), np.int32).tobytes() for h in held],
                    np.full(terms, 700, np.int64), size, int(lengths.sum()))
    opened = []
    plain = block.bounds
    block.bounds = lambda m, a, b: opened.append(len(a)) or plain(m, a, b)
    scores, _ = block.search(np.arange(12), np.ones(12, np.int64), (np.zeros(0, np.int64), np.zeros(0, np.int64)), 20)
    assert len(scores) == 20 and sum(opened) < 2 * size


def test_long_texts_in_pieces(monkeypatch):
    text = ("Ab1 cd-EF\n" * 400 + "y" * 999).encode()
    whole = [t for part in S.terms(text) for t in part]
    monkeypatch.setattr(S, "PIECE", 37)
    assert [t for part in S.terms(text) for t in part] == whole == [t.encode() for t in split(text.decode())]
