import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from tillcast.llm import kneser_ney as K

N = K.ORDER


def brute_model(texts):
    """Probability function of an interpolated modified Kneser-Ney model."""
    pad = K.BEGIN * (N - 1)
    count = {N: Counter((pad + t)[i - N + 1:i + 1] for t in texts for i in range(N - 1, len(pad + t)))}
    for k in range(N - 1, 0, -1):
        count[k] = Counter(g[1:] for g in count[k + 1])
    cut, total, left = {}, defaultdict(float), defaultdict(float)
    for k in range(1, N + 1):
        n = [sum(v == i for v in count[k].values()) for i in range(6)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else None
        for i in (1, 2, 3):
            d = i - (i + 1) * y * n[i + 1] / n[i] if y is not None and n[i] else 0.5 * i
            cut[k, i] = min(max(d, 0.1), 0.95 * i)
        for g, c in count[k].items():
            total[g[:-1], k] += c
            left[g[:-1], k] += cut[k, min(c, 3)]
    v = len(count[1]) + 1

    def p(g):
        k = len(g)
        lower = p(g[1:]) if k else None
        if not k:
            return 1 / v
        ctx = (g[:-1], k)
        if ctx not in total:
            return lower
        c = count[k].get(g, 0)
        own = (c - cut[k, min(c, 3)]) / total[ctx] if c else 0
        return own + left[ctx] / total[ctx] * lower

    return lambda t: math.exp(-sum(math.log(p((pad + t)[i - N + 1:i + 1])) for i in range(N - 1, len(pad + t))) / len(t))


def test_grams():
    rnd = random.Random(1)
    for table in (K.TABLE, 1):
        K.TABLE, was = table, K.TABLE
        texts = ["", "a", "abab", "é日本 ab", "".join(rnd.choices("abc", k=500)), ""]
        g = K.Grams(texts)
        want = Counter((K.BEGIN * (N - 1) + t)[i:i + N] for t in texts for i in range(len(t)))
        got = {"".join(map(chr, row)): n for row, n in zip(g.chars, g.counts(), strict=True)}
        assert got == want
        value = np.arange(len(g.chars)) * 0.5
        index = {"".join(map(chr, row)): v for row, v in zip(g.chars, value, strict=True)}
        assert np.allclose(g.sums(value), [sum(index[(K.BEGIN * (N - 1) + t)[i:i + N]] for i in range(len(t))) for t in texts])
        K.TABLE = was
    assert len(K.Grams([]).chars) == 0 and len(K.Grams([""]).chars) == 0


def test_against_brute_force(spark):
    rnd = random.Random(3)
    words = {"en": ["the", "thing", "of", "shell"], "fr": ["le", "école", "être", "à"], "": ["no", "lang"]}
    rows = []
    for i in range(300):
        k = rnd.choice(["en", "en", "fr", None])
        text = " ".join(rnd.choices(words[k or ""], k=rnd.randrange(1, 25)))
        rows.append((i, text if i % 5 else text.upper() + " 日本 !!", k, "good" if i % 3 == 0 and i % 5 else rnd.choice(["other", None])))
    rows += [(900, None, "en", "good"), (501, "", "fr", "other"), (502, "sin modelo", "es", "other"), (None, "the thing", "en", "other"), (3, *rows[3][1:]), (3, *rows[3][1:]),
             (504, "of the " * 20_000, "en", "other"), (505, "one more without", "es", "other")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, source string, trusted string").repartition(3)
    got = K.kneser_ney_quality(df, F.col("source") == "good", quantile=0.9).collect()
    assert len(got) == len(rows)
    models, costs = {}, {}
    out = {(r.doc_id, r.text): r.held for r in df.select("doc_id", "text", K.held_out().alias("held")).collect()}
    for k in ("en", "fr", ""):
        texts = [(i, t) for i, t, lang, s in rows if (lang or "") == k and s == "good" and t]
        models[k] = brute_model([t for i, t in texts if not out[i, t]])
        costs[k] = sorted(math.floor(math.log(models[k](t)) * K.STEPS + 1e-9) for i, t in texts if out[i, t])
    want = Counter()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i, t, lang, s in rows:
        r = by[i].pop()
        k = lang or ""
        assert (r.lang, r.trusted, r.n_chars) == (k, s == "good", len(t or ""))
        if not t:
            assert r.perplexity is None and r.kept is False
        elif k == "es":
            assert r.perplexity is None and r.threshold is None and r.kept is True
        else:
            exact = models[k](t)
            assert abs(r.perplexity - exact) < 1e-3 * exact, (t, r, exact)
            if not costs[k]:
                assert r.threshold is None and r.kept
                continue
            limit = costs[k][math.ceil(0.9 * len(costs[k])) - 1]
            assert abs(math.log(r.threshold) * K.STEPS - limit - 1) <= 1.01
            assert r.kept == (math.floor(math.log(r.perplexity) * K.STEPS) <= round(math.log(r.threshold) * K.STEPS) - 1)
            want[k, r.kept] += 1
    assert want["en", False] > 3 and want["en", True] > 10
    assert K.kneser_ney_quality(df.limit(0), F.col("source") == "good").count() == 0


def test_quality_of_the_given_documents(spark):
    from tillcast.llm.queries import trusted_text

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = K.kneser_ney_quality(docs, trusted_text()).join(labels, "doc_id").toPandas()
    out = out[~out.trusted]
    good, bad = out[out.quality == 1], out[out.quality == 0]
    assert np.mean(good.kept) >= 0.95 and np.mean(~bad.kept) >= 0.5
