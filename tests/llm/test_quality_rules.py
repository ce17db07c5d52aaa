import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tillcast.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    inside = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside))


CASES = ["", None, " \n", "a", "é ü", "a b c d e f g h", "a b c d e f g h " * 2, "x " * 40, "a\nb\na\na\n \n \n", "# | <p> $5", "w\x1cv\x85\xa0z",
         "one two three four five six seven eight nine ten\n" * 4, "ab " * 20_000, "a\tb\x0bc\x0cd\re"]


def counts(texts):
    clean = [t or "" for t in texts]
    return list(zip(*[c.tolist() for c in Q.rule_counts(clean, Q.Batch(clean)).values()], strict=True))


def test_counts():
    assert counts(CASES) == [brute(t) for t in CASES]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n#é\t", max_size=120), min_size=1, max_size=5))
def test_counts_of_any_text(texts):
    assert counts(texts) == [brute(t) for t in texts]


def test_margin_of_a_text_does_not_depend_on_its_batch():
    rng = np.random.default_rng(1)
    model = Q.Classifier()
    model.weights = rng.normal(size=model.weights.shape).astype(np.float32)
    texts = [t or "" for t in CASES] + ["".join(rng.choice(list("abc dé\n"), 300)) for _ in range(20)]
    whole = model.margins(Q.Batch(texts))
    assert whole.tolist() == [model.margins(Q.Batch([t]))[0] for t in texts]
    for t, m in zip(texts, whole, strict=True):
        want = 0.0
        for w, (kind, n) in zip(model.weights, Q.KINDS, strict=True):
            bucket, _, size = Q.Batch([t]).grams(kind, n)
            if size[0]:
                want += Q.SCALE * float(w[bucket[:size[0]]].astype(float).mean())
        assert abs(m - want) < 1e-3


def test_frame(spark):
    rnd = random.Random(2)
    good, bad = ["plain", "words", "of", "prose", "and", "more"], ["BUY!!", "$$$", "NOW", "|", "###", "FREE"]
    rows, labels = [], []
    for i in range(300):
        q = rnd.randrange(2)
        rows.append((i, " ".join(rnd.choices(good if q else bad, k=rnd.randrange(15, 60)) + [f"w{i}{k}" for k in range(9)])))
        if i % 3:
            labels.append((i, q))
    rows += [(900, None), (901, ""), (None, rows[0][1]), (0, rows[0][1]), (902, "same eight words in a row again and " * 30)]
    labels += [(1, 0), (1, 1), (None, 1), (2, None), (5000, 1)]
    docs = spark.createDataFrame([(i, t, "s", 0.1) for i, t in rows], "doc_id long, text string, kept string, score double").repartition(3)
    marks = spark.createDataFrame([(*x, 7) for x in labels], "doc_id long, quality int, label int")
    got = Q.quality_rules(docs, marks).collect()
    assert len(got) == len(rows)
    want = sorted([(i, *brute(t)) for i, t in rows], key=str)
    assert sorted([tuple(r)[:6] for r in got], key=str) == want
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= Q.KEEP) and 0 <= r.score <= 1
    texts = dict(rows)
    judged = [r for r in got if r.doc_id is not None and r.doc_id < 300 and not r.base_failed]
    assert np.mean([r.kept == ("$" not in texts[r.doc_id] and "|" not in texts[r.doc_id] and "!" not in texts[r.doc_id]) for r in judged]) > 0.97
    assert Q.quality_rules(docs.limit(0), marks).count() == 0
    assert all(r.kept == (not r.base_failed) for r in Q.quality_rules(docs, marks.limit(0)).collect())


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = Q.train_quality(docs, labels.filter("doc_id % 2 = 0"))
    out = Q.apply_quality(docs, model).join(labels.filter("doc_id % 2 = 1"), "doc_id").toPandas()
    assert len(out) > 1000 and np.mean(out.kept == (out.quality == 1)) >= 0.9
    good = out[out.quality == 1]
    judged = good[~good.base_failed]
    assert np.mean(judged.kept) >= 0.97
