import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tillcast.llm import language_id as L


def brute_phrases(text, sample):
    """Phrases of blocks of plain text by str.find."""
    text, sample, n = L.plain(text), L.plain(sample), 0
    for b in range(0, len(text), L.BLOCK):
        part, at = text[b:b + L.BLOCK], 0
        while at < len(part):
            size = 1
            while at + size <= len(part) and part[at:at + size] in sample:
                size += 1
            at += max(1, size - 1)
            n += 1
    return n


def test_phrases_against_find():
    rnd = random.Random(5)
    samples = {"xx": "".join(rnd.choices("abc de", k=400)), "yy": "".join(rnd.choices("aBcdéf ", k=300)) + "!"}
    texts = ["", None, "123 !!", "a", "zzz", "  A  b ", "é", *("".join(rnd.choices("abcdeéfZ  .", k=k)) for k in (3, 50, 255, 256, 257, 1500))]
    parser = L.Parser(samples)
    counts, length = parser.phrases(texts)
    for i, t in enumerate(texts):
        if not any(c.isalpha() for c in t or ""):
            assert length[i] == 0 and not counts[:, i].any()
            continue
        assert length[i] == len(L.plain(t))
        assert [brute_phrases(t, samples[k]) for k in parser.langs] == counts[:, i].tolist(), t


def test_large_alphabets():
    """Two languages of 400 Han letters each: no letter falls together with
    another, by phrases of digits against str.find."""
    rnd = random.Random(6)
    han = [chr(0x4E00 + i) for i in range(800)]
    one, two = han[:400], han[400:]
    parser = L.Parser({"xx": "".join(rnd.choices(one, k=3000)), "yy": "".join(rnd.choices(two, k=3000))})
    assert parser.digits == 2 and len({tuple(v) for v in parser.code.values()}) == len(parser.code)
    texts = ["".join(rnd.choices(src, k=40)) for src in (one, two, one[300:], two[300:])] + ["abc " + one[5], "zzz"]
    assert [x for x, _ in parser.predict(texts)][:4] == ["xx", "yy", "xx", "yy"]
    counts, length = parser.phrases(texts)
    write = lambda t: "".join(chr(1000 + x) for c in L.plain(t) for x in ([0] if c == " " else parser.code.get(c, [parser.width - 2])))
    for k, name in enumerate(parser.langs):
        sample = write(parser.samples[name])
        for i, t in enumerate(texts):
            part, at, n = write(t), 0, 0
            while at < len(part):
                size = 1
                while at + size <= len(part) and part[at:at + size] in sample:
                    size += 1
                at, n = at + max(1, size - 1), n + 1
            assert counts[k, i] == n and length[i] == len(L.plain(t))


def test_one_long_document_is_no_sample(spark):
    rnd = random.Random(3)
    rows = [(i, " ".join(rnd.choices(["alpha", "beta", "gamma"], k=40)), "en") for i in range(40)] + [(i, "zzz " * 300_000, "en") for i in range(40, 44)]
    parser = L.fit_parser(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_chars=8000)
    assert "alpha" in parser.samples["en"] and parser.samples["en"].count("zzz") * 4 <= 4 * 1000 + 4


def test_known_language(spark):
    rows = [(i, "the thing of shell", "en") for i in range(30)] + [(i, "le chose avec être", "fr") for i in range(30, 60)]
    rows += [(60, "12 %", "en"), (61, None, "fr"), (62, "le chose avec", "en"), (63, "the thing", None)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, lang string, n int")
    got = {r.doc_id: r.lang for r in L.known_language(df).collect()}
    assert got == {i: "en" for i in range(30)} | {i: "fr" for i in range(30, 60)} | {62: "fr", 63: "en"}
    plain = L.known_language(df.withColumn("lang", F.lit(None).cast("string")))
    assert plain.columns == df.columns and {r.doc_id: r.lang for r in plain.collect()} == {i: None for i in [*range(60), 62, 63]}


def test_frame(spark):
    rnd = random.Random(2)
    words = {"en": ["the", "of", "thing", "shell", "with"], "fr": ["le", "être", "chose", "école", "avec"]}
    rows = [(i, " ".join(rnd.choices(words[k], k=30)), k) for i in range(200) for k in [rnd.choice(["en", "fr"])]]
    rows += [(900, None, "en"), (901, "12 %", "fr"), (902, "the thing of", None), (None, "le avec être", "fr"), (903, "THE " * 50_000, "en"), (0, *rows[0][1:])]
    df = spark.createDataFrame([(*r, "a", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = L.language_id(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, k in rows:
        assert by[i].held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= by[i].score <= 1
        if i in (900, 901):
            assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
        else:
            assert by[i].lang_pred == (k or "en")
    assert L.language_id(df.limit(0)).count() == 0
    none = L.language_id(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in none.collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = L.language_id(docs).join(docs, "doc_id").filter("held_out").toPandas()
    assert np.mean(out.lang_pred == out.lang) >= 0.97
