"""Similarity scores against brute force on small fixtures."""

import numpy as np

from tillcast.operators import synth as syn


def test_ks_complement_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    a = [float(x) for x in rng.integers(0, 30, 200)]
    b = [float(x) for x in rng.integers(5, 40, 150)]
    ra = spark.createDataFrame([(x, x * 2) for x in a], "x double, y double")
    sb = spark.createDataFrame([(x, x * 2) for x in b], "x double, y double")
    got = {r.column: r.ks_complement for r in syn.ks_complement(ra, sb, ["x", "y"]).collect()}
    grid = np.union1d(a, b)
    fa = np.searchsorted(np.sort(a), grid, side="right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, side="right") / len(b)
    expect = 1 - np.max(np.abs(fa - fb))
    assert abs(got["x"] - expect) < 1e-12 and abs(got["y"] - expect) < 1e-12


def test_tv_and_contingency_with_null_category(spark):
    ra = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), ("b", 1)], "c string, d int")
    sb = spark.createDataFrame([("a", 1), (None, 2), (None, 2), ("c", 1)], "c string, d int")
    tv = syn.tv_complement(ra, sb, ["c"]).first().tv_complement
    p = {"a": 0.5, None: 0.25, "b": 0.25}
    q = {"a": 0.25, None: 0.5, "c": 0.25}
    keys = set(p) | set(q)
    assert abs(tv - (1 - 0.5 * sum(abs(p.get(k, 0) - q.get(k, 0)) for k in keys))) < 1e-12
    cs = syn.contingency_similarity(ra, sb, [("c", "d")]).first().contingency_similarity
    pj = {("a", 1): .25, ("a", 2): .25, (None, 1): .25, ("b", 1): .25}
    qj = {("a", 1): .25, (None, 2): .5, ("c", 1): .25}
    kj = set(pj) | set(qj)
    assert abs(cs - (1 - 0.5 * sum(abs(pj.get(k, 0) - qj.get(k, 0)) for k in kj))) < 1e-12


def test_running_sums_match_a_window(spark, monkeypatch):
    from tillcast.operators import ranking
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from tillcast.operators.ranking import cumulative_sums
    rows = [(v % 2, float(v), int(w1), int(w2)) for v, w1, w2 in
            zip(range(300), np.arange(300) % 5, np.arange(300) % 3)]
    df = spark.createDataFrame(rows, "k int, v double, a long, b long")
    w = Window.partitionBy("k").orderBy("v")
    want = {(r.k, r.v): (r.x, r.y) for r in df.select("k", "v", F.sum("a").over(w).alias("x"), F.sum("b").over(w).alias("y")).collect()}
    for small in (ranking.SMALL_PAIRS, 0):      # one window for each k, and sums by range
        monkeypatch.setattr(ranking, "SMALL_PAIRS", small)
        assert {(r.k, r.v): (r.a_cum, r.b_cum) for r in cumulative_sums(df, ["a", "b"]).collect()} == want


def test_diagnostic_reports_missing_and_odd_columns(spark):
    real = spark.createDataFrame([(1.0, "a", 1), (3.0, None, 2)], "x double, c string, gone int")
    synth = spark.createDataFrame([(2.0, "a"), (9.0, "z"), (1.0, None), (3.0, "a")], "x float, c string")
    got = {r.column: r for r in syn.diagnostic(real, synth, ["x", "gone"], ["c", "never"]).collect()}
    assert (got["x"].present, got["x"].same_type, got["x"].valid_share) == (True, False, 0.75)
    assert (got["c"].present, got["c"].valid_share) == (True, 0.75)
    assert (got["gone"].present, got["gone"].valid_share) == (False, None)
    assert got["never"].present is False


def test_quality_report_of_equal_frames_is_one(spark):
    df = spark.createDataFrame([(float(i % 7), float(i * i % 11), 5.0, "ab"[i % 2], None) for i in range(60)],
                               "x double, y double, k double, c string, n string")
    rows = {(r.section, r.name): r.score for r in syn.quality_report(df, df, ["x", "y", "k"], ["c", "n"]).collect()}
    assert all(abs(v - 1) < 1e-9 for v in rows.values())
    assert ("trend", "x~y") in rows and ("trend", "x~c") in rows and ("trend", "c~n") in rows and ("mean", "overall") in rows
    assert ("trend", "x~k") not in rows   # a constant column has no correlation
    other = df.withColumn("x", df.x + 100)
    worse = {(r.section, r.name): r.score for r in syn.quality_report(df, other, ["x", "y", "k"], ["c", "n"]).collect()}
    assert worse["shape", "x"] == 0 and worse["mean", "overall"] < 1


def test_pairs_of_values_are_counted_by_block(spark, monkeypatch):
    """Not a row for each row and pair: each pair's values once a block, whichever
    way they are counted, and the same score as by hand."""
    from collections import Counter

    rng = np.random.default_rng(3)
    draw = lambda n: [(None if rng.random() < .1 else f"x{rng.integers(4)}", int(rng.integers(300)), rng.choice(["", "null", '"', None])) for _ in range(n)]
    real, other = draw(900), draw(500)
    ra, sb = (spark.createDataFrame(x, "a string, b int, c string").repartition(2) for x in (real, other))
    names = [("a", "b"), ("a", "c"), ("c", "b")]
    at = {"a": 0, "b": 1, "c": 2}
    for rows in (syn.BLOCK_ROWS, 100):
        monkeypatch.setattr(syn, "BLOCK_ROWS", rows)
        scores = syn.contingency_similarity(ra, sb, names)
        assert "Generate" not in scores._jdf.queryExecution().toString()
        got = {(r.col_a, r.col_b): r.contingency_similarity for r in scores.collect()}
        for x, y in names:
            p, q = (Counter((r[at[x]], r[at[y]]) for r in t) for t in (real, other))
            want = 1 - 0.5 * sum(abs(p[k] / len(real) - q[k] / len(other)) for k in p | q)
            assert abs(got[x, y] - want) < 1e-12
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"a": a, "b": str(b), "c": c} for a, b, c in real])
    made = list(syn._pair_counts([(0, 2)])(iter([batch])))
    assert sum(b.num_rows for b in made) == len({(r[0], r[2]) for r in real}) and sum(n for b in made for n in b.column("n").to_pylist()) == len(real)
