import hashlib
import random

import pytest

from tillcast.llm import exact_dedup as X


def brute(rows):
    body = lambda t: "".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in rows:
        groups.setdefault(body(t), []).append((-len(t or ""), i is None, i or 0))
    out = []
    for i, t in rows:
        own = groups[body(t)]
        best = min(own)
        keep = None if best[1] else best[2]
        out.append((i, keep, len(own), (i, -len(t or "")) == (keep, best[0]), hashlib.sha256(body(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [X.MEMORY_LIMIT, 1])
def test_against_brute_force(spark, limit):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["", " ", None, "a b", "ab", "a\tb ", "é", "long " * 4000, "abc", "abd", "ab ", "ABC"])) for i in range(300)]
    rows += [(None, "ab"), (None, "only null"), (5, "a b"), (5, "a b"), (None, None)]
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, keep_id string").repartition(4)
    got = sorted(map(tuple, X.exact_dedup(df, memory_limit=limit).collect()), key=str)
    assert got == brute(rows)
    assert X.exact_dedup(df.limit(0)).count() == 0


def test_trie():
    rnd = random.Random(1)
    for _ in range(200):
        trie, want = X.Patricia(), {}
        for _ in range(40):
            key = bytes(rnd.choices(b"ab", k=rnd.randrange(1, 9)))
            owner = (-rnd.randrange(3), False, rnd.randrange(5))
            trie.insert(key, owner, 1)
            a, n = want.get(key, (owner, 0))
            want[key] = (min(a, owner), n + 1)
        kept = rnd.choice([None, ord("a")])
        out = {k: (o, n) for k, o, n in trie.spill(kept)}
        out |= {k: (o, n) for k, o, n in trie.entries()}
        assert out == want
