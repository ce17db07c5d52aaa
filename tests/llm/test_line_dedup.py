import random

from tillcast.llm.line_dedup import line_dedup


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)


def brute(rows, min_chars=40, min_docs=5):
    holders = {}
    for n, (i, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                holders.setdefault(k, []).append(i)
    top = {k: max(i for i in v if i is not None) for k, v in holders.items() if len(v) >= min_docs and any(i is not None for i in v)}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        stay = [x for x in lines if key(x) not in top or i == top[key(x)]]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rnd = random.Random(8)
    lines = [f"Line {i} " + "long enough to count, ÀÉ " * 2 for i in range(12)] + ["short", "", "  ", "x" * 40, "x" * 39, "É" * 40, "y" * 90_000]
    var = lambda s: rnd.choice([s, s.upper().replace("À", "à") if s.isascii() else s, " " + s + "\t", s + "\r"])
    rows = [(i, "\n".join(var(rnd.choice(lines)) for _ in range(rnd.randrange(9)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n"), (None, lines[0]), (None, None), (33, rows[33][1]), (33, lines[2])]
    rows += [(None, "only rows without an id hold this one line here")] * 6
    rows.append((300, "\n".join(["z" * 50] * 3000)))
    rows += [(301 + i, "z" * 50) for i in range(4)]
    df = spark.createDataFrame([(i, t, "q", 7) for i, t in rows], "doc_id long, text string, key string, N_LINES int").repartition(3)
    for batches, fanout in ((4, 2), (1, 2), (7, 3)):
        got = line_dedup(df, batches=batches, fanout=fanout, counts=True)
        assert got.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str) == brute(rows)
    assert line_dedup(df).columns == df.columns
    assert line_dedup(df.limit(0), counts=True).count() == 0
