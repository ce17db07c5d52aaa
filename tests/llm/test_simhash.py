import random

import numpy as np
import xxhash

from tillcast.llm import simhash as S


def brute_print(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows):
    prints = [brute_print(t) for _, t in rows]
    comp = list(range(len(rows)))
    for _ in rows:
        new = [min(comp[j] for j in range(len(rows)) if (prints[i] ^ prints[j]).bit_count() <= 4) for i in range(len(rows))]
        if new == comp:
            break
        comp = new
    first = {}
    for (i, _), c in zip(rows, comp, strict=True):
        if i is not None:
            first[c] = min(i, first.get(c, i))
    return sorted(((i, f"{p:016x}", first.get(c)) for (i, _), p, c in zip(rows, prints, comp, strict=True)), key=str)


def test_code():
    error, lists = S.neighbours()
    assert len(error) == 2048 and (np.bitwise_count(error) <= 3).all() and len(set(error.tolist())) == 2048
    message = np.arange(1 << 12, dtype=np.int32) << 11
    words = message ^ S.remainder(message)
    assert not S.remainder(words).any() and np.bitwise_count(words)[1:].min() == 7
    assert (np.diff(lists[0][1]) == 1).all()


def test_every_pair_within_four_bits_meets():
    rng = np.random.default_rng(7)
    for bits in range(5):
        for _ in range(60):
            x = int(rng.integers(0, 1 << 64, dtype=np.uint64))
            y = x
            for b in rng.choice(64, bits, replace=False):
                y ^= 1 << int(b)
            home = S.home_anchors(np.array([x], np.uint64))[:, 0]
            reach = np.concatenate([a for a, _ in S.all_anchors(np.array([y], np.uint64))])
            assert np.isin(home, reach).any()
            assert len(set(reach.tolist())) == len(reach)


def test_replicas_are_not_broadcast(spark):
    """However small the fingerprints are, their homes and replicas aren't broadcast."""
    prints = np.random.default_rng(5).integers(-1 << 62, 1 << 62, 40).tolist()
    plan = S.links(spark.createDataFrame([(x,) for x in prints], "fp long"))._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_links_of_dense_groups(spark):
    rng = np.random.default_rng(3)
    prints = set()
    for size, reach in ((60, 2), (60, 5), (30, 12)):
        center = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        for _ in range(size):
            x = center
            for b in rng.choice(64, int(rng.integers(0, reach + 1)), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    prints = np.array(sorted(prints), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    edges = {(r.a, r.b) for r in S.links(df).collect()}
    up = {int(x): int(x) for x in prints.view(np.int64)}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        up[find(a)] = find(b)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    signed = prints.view(np.int64).tolist()
    for i, j in zip(*np.nonzero(near), strict=True):
        assert find(signed[i]) == find(signed[j])
    index = {s: k for k, s in enumerate(signed)}
    assert all(near[index[a], index[b]] for a, b in edges)


def test_frame(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(60)] + ["É", "ABC", "x" * 300]
    base = [" ".join(rnd.choices(words, k=rnd.choice([1, 3, 4, 5, 40, 200, 900]))) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(100, 190):
        t = rnd.choice(base).split(" ")
        for _ in range(rnd.randrange(3)):
            t[rnd.randrange(len(t))] = rnd.choice(words)
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(t).upper() if i % 7 == 0 else " ".join(t)))
    rows += [(50, None), (51, ""), (52, " \n"), (None, base[0]), (None, "only here, without an id"), (3, base[3]), (3, base[3])]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, fp string").repartition(3)
    got = sorted(map(tuple, S.simhash_components(df).collect()), key=str)
    assert got == brute_components(rows)
    kept = S.simhash_dedup(df)
    assert kept.columns == df.columns
    want = sorted(str(i) for i, _, c in got if i is None or i == c)
    assert sorted(str(r.doc_id) for r in kept.collect()) == want
    assert S.simhash_components(df.limit(0)).count() == 0 and S.simhash_dedup(df.limit(0)).count() == 0
