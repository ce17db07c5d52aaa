import hashlib
import random
import re

from tillcast.llm.mixing import mix_to_weights


def fill(pool, nodes):
    """nodes: name -> (cap, weight); water filling with whole tokens, the
    open nodes sharing by cumulated rounding in the order of cap / weight."""
    order = sorted(nodes, key=lambda k: (nodes[k][0] / nodes[k][1], k))
    open_, out = list(order), {}
    while True:
        weight = sum(nodes[k][1] for k in open_)
        full = [k for k in open_ if pool * nodes[k][1] >= nodes[k][0] * weight]
        if not full:
            break
        for k in full:
            out[k] = nodes[k][0]
            pool -= nodes[k][0]
            open_.remove(k)
    upto = 0
    for k in open_:
        w = nodes[k][1]
        out[k] = pool * (upto + w) // weight - pool * upto // weight
        upto += w
    return out


def brute(rows, weights, share, epochs, seed):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    w = lambda path: [weights[k].get(x, 1) for k, x in enumerate(path)]
    leaves = {}
    for i, t, *path in rows:
        path = tuple(x or "" for x in path)
        if count(t) and all(w(path)):
            leaves.setdefault(path, {}).setdefault(i, []).append(count(t))
    supply = {p: sum(map(sum, v.values())) for p, v in leaves.items()}
    total = sum(supply.values())
    budget = {(): min(total * share[0] // share[1], total * epochs)}
    for depth in range(3):
        for head in [p for p in budget if len(p) == depth]:
            caps = {}
            for p, s in supply.items():
                if p[:depth] == head:
                    caps[p[depth]] = caps.get(p[depth], 0) + s * epochs
            if caps:
                for k, b in fill(budget[head], {k: (c, weights[depth].get(k, 1)) for k, c in caps.items()}).items():
                    budget[(*head, k)] = b
    out = []
    for p, docs in leaves.items():
        full, rest = divmod(budget[p], supply[p])
        for i, ns in docs.items():
            out += [(i, *p, e, n, n) for n in ns for e in range(1, full + 1)]
        seat = lambda i: hashlib.md5(f"{seed}:{full + 1}:{'' if i is None else i}".encode()).hexdigest()
        for i in sorted(docs, key=seat):
            if rest <= 0:
                break
            out += [(i, *p, full + 1, n, min(n, rest)) for n in docs[i]]
            rest -= sum(docs[i])
    return sorted(out, key=str), budget


def test_against_brute_force(spark):
    rnd = random.Random(6)
    rows = []
    for i in range(400):
        source = rnd.choices(["a", "b", "c", "d", None], [60, 20, 10, 5, 1])[0]
        rows.append((i, " ".join("w" * rnd.randrange(1, 4) for _ in range(rnd.choice([0, 1, 5, 60]))), "x" if source == "a" else "y", rnd.choice(["en", "fr", None]), source))
    rows += [(500, None, "x", "en", "a"), (501, " \n\t", "x", "en", "a"), (7, *rows[7][1:]), (7, *rows[7][1:]), (None, "no id " * 5, "y", "en", "b"),
             (502, "long " * 60_000, "z", "en", "only"), (503, "left out", "w", "en", "a")]
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, domain string, lang string, source string, EPOCH int, _n string").repartition(3)
    for weights, share, epochs in (([{"x": 3, "y": 2, "w": 0}, {"en": 2}, {}], (1, 20), 3), ([{"w": 0}, {"fr": 9}, {"d": 50}], (2, 1), 2), ([{}, {}, {}], (9, 1), 2)):
        got = mix_to_weights(df, ["domain", "lang", "source"], weights, share, epochs, 5)
        assert got.columns == ["doc_id", "text", "domain", "lang", "source", "_n", "epoch", "n_tokens", "take_tokens"]
        want, budget = brute(rows, weights, share, epochs, 5)
        mine = sorted(((r.doc_id, r.domain, r.lang or "", r.source or "", r.epoch, r.n_tokens, r.take_tokens) for r in got.collect()), key=str)
        assert mine == want
    assert mix_to_weights(df.limit(0), ["domain", "lang", "source"], [{}, {}, {}]).count() == 0


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "t " * 100, "d1", "en", "s1") for i in range(2)] + [(10 + i, "t " * 100, "d1", "en", "s2") for i in range(50)]
    rows += [(100 + i, "t " * 100, "d2", "en", "s3") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    got = mix_to_weights(df, ["domain", "lang", "source"], [{}, {}, {}], (40, 102), 1).groupBy("source").sum("take_tokens").collect()
    assert {r[0]: r[1] for r in got} == {"s1": 200, "s2": 1800, "s3": 2000}
