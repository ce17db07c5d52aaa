import math
import random

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import test_line_dedup, test_mixing, test_simhash
from tests.llm.test_bpe import real
from tests.llm.test_language_id import brute_phrases
from tillcast.llm import simhash
from tillcast.llm.language_id import fit_parser, held_out
from tillcast.llm.queries import DOMAIN_WEIGHTS, DOMAINS, LANG_WEIGHTS, OTHER_DOMAIN, SOURCE_WEIGHTS


def brute(rows, parser):
    rows = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    cost = lambda text, k: brute_phrases(text, parser.samples[k]) * math.log2(max(2, len(parser.samples[k])))
    rows = [(i, t, min(parser.langs, key=lambda k: cost(t, k)), s) for i, t, _, s in rows]
    left = {i: t for i, t, _, _ in test_line_dedup.brute([(i, t) for i, t, *_ in rows])}
    rows = [(i, left[i], *r) for i, _, *r in rows]
    first = {i: c for i, _, c in test_simhash.brute_components([(i, t) for i, t, *_ in rows])}
    rows = [r for r in rows if first[r[0]] == r[0]]
    texts = {r[0]: r[1] for r in rows}
    taken, _ = test_mixing.brute([(i, t, DOMAINS.get(s, OTHER_DOMAIN), k, s) for i, t, k, s in rows],
                                 [DOMAIN_WEIGHTS, LANG_WEIGHTS, SOURCE_WEIGHTS], (1, 1), 2, 17)
    return sorted((i, real(texts[i])[0]) for i, *_ in taken)


def test_run(spark, tmp_path):
    rnd = random.Random(11)
    words = {"en": ["the", "of", "thing", "shell", "with", "Anders"], "fr": ["le", "être", "chose", "école", "avec"], "es": ["el", "niño", "cosa", "con", "año"]}
    often = ["This line stands in very many documents here. " + w for w in ("One", "Two", "Three")]
    rows = []
    for i in range(150):
        k = rnd.choice(["en", "en", "fr", "es"])
        text = "\n".join([" ".join(rnd.choices(words[k], k=rnd.randrange(3, 30))) for _ in range(3)] + rnd.sample(often, rnd.randrange(3)))
        rows.append((i, text, k, rnd.choice(["src0", "src0", "src3", "src9", "src15"])))
    rows += [(200 + n, rows[n % 9][1], *rows[n % 9][2:]) for n in range(40)]
    rows += [(300, None, "en", "src1"), (301, "", "fr", "src1"), (302, "12 % 4", "en", "src2"), (303, often[0], "en", "src4"), (304, "no lang here of the", None, None)]
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    parser = fit_parser(df.filter(~held_out("doc_id")))
    assert sorted((r.doc_id, r.ids) for r in got.collect()) == brute(rows, parser)
    # without a label the documents stay
    bare = df.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, bare, str(tmp_path)).count() == sum(any(c.isalpha() for c in r[1] or "") for r in rows)
    docs = df
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == df.columns
    empty = f"{tmp_path}/empty"
    df.limit(0).write.parquet(f"{empty}/documents.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_near_dedup_broadcasts_no_replicas(spark, tmp_path, monkeypatch):
    plans, plain = [], simhash.components

    def spy(edges):
        plans.append(edges._jdf.queryExecution().sparkPlan().toString())
        return plain(edges)

    monkeypatch.setattr(simhash, "components", spy)
    df = spark.createDataFrame([(i, f"some words of text {i} and of text {i * i}", "en", "src1", 40) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    assert corpus_pipeline.near_dedup(spark, df, str(tmp_path)).count() > 0
    assert len(plans) == 1 and "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
