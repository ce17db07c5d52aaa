import hashlib
import itertools
import random
import zlib

import pytest

from tillcast.llm import conversation_repair as R

SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        one = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{one(conv)}:{one(turn)}".encode()) % 20
        role, text = one(role), one(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.rstrip(SPACES)
        out.append("b" if not body else "d" if (role, text) in seen else "o" if body[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit, repaired rows) by plain search over prefixes: the
    states are what the grammar allows next."""
    allowed = {"": ["s", "u"], "s": ["u"], "u": ["a"], "a": ["u"]}
    now = {"": (0, "", ())}

    def put(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def inserts(of):
        for _ in range(3):
            for state, (c, a, r) in list(of.items()):
                for role in set(allowed[state]) - {"s"}:
                    put(of, role, (c + 2, a + "I", (*r, ("user" if role == "u" else "assistant", ""))))
        return of

    for (_, _, role, text), fault in zip(rows, found, strict=True):
        after = {}
        for state, (c, a, r) in inserts(dict(now)).items():
            put(after, state, (c + 3, a + "D", r))
            if fault in "ot":
                for new in allowed[state]:
                    extra = fault == "t"
                    if role[:1] == new:
                        put(after, new, (c + extra, a + "K", (*r, (role, text))))
                    if new != "s":
                        put(after, new, (c + 2 + extra, a + "R", (*r, ("user" if new == "u" else "assistant", text))))
        now = after
    return min(w for s, w in inserts(now).items() if s in ("", "a"))


def brute(rows):
    out = []
    for conv in dict.fromkeys(r[0] for r in rows):
        mine = damage([r for r in rows if r[0] == conv])
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        found = faults(mine)
        turns = {r[1] for r in mine} - {None}
        cost, audit, fixed = cheapest(mine, found)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(f) for f in "bdt"), illegal, cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()))
    return sorted(out, key=str)


def search(sig):
    """All edit sequences of a short signature, inserts up to two in a gap."""
    best = None
    for edits in itertools.product("DKR", repeat=len(sig)):
        if any(R.FAULTS[(ord(s) - 65) % 4] in "bd" and e != "D" for s, e in zip(sig, edits, strict=True)):
            continue
        for gaps in itertools.product(range(3), repeat=len(sig) + 1):
            for roles in itertools.product("ua", repeat=edits.count("R") + sum(gaps)):
                left, audit, out, cost = list(roles), "", "", 0
                for k in range(len(sig) + 1):
                    for _ in range(gaps[k]):
                        audit, out, cost = audit + "I", out + left.pop(), cost + 2
                    if k < len(sig):
                        at = ord(sig[k]) - 65
                        audit += edits[k]
                        cost += {"D": 3, "K": 0, "R": 2}[edits[k]] + (edits[k] != "D" and R.FAULTS[at % 4] == "t")
                        out += {"D": "", "K": R.ROLES[at // 4], "R": left[-1] if left else ""}[edits[k]]
                        if edits[k] == "R":
                            left.pop()
                body = out[1:] if out[:1] == "s" else out
                if (not out or body and len(body) % 2 == 0 and body == "ua" * (len(body) // 2)) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


def judged(sigs):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(sorted(sigs, key=lambda s: s[::-1]), pa.string())], names=["sig"])
    return {r["sig"]: r for out in R.audits(iter([batch])) for r in out.to_pylist()}


def test_short_signatures_against_all_edits():
    rnd = random.Random(1)
    letters = [R.symbol(r, f) for r in R.ROLES for f in R.FAULTS]
    sigs = {""} | set(letters) | {"".join(rnd.choices(letters, k=k)) for k in (2, 2, 2, 3, 3, 3) for _ in range(4)}
    for sig, row in judged(sigs).items():
        assert (row["cost"], row["audit"]) == search(sig), sig


def test_nodes_are_made_once():
    R.step.cache_clear()
    made = []
    plain = R.step
    R.step = lambda *a: made.append(a) or plain(*a)
    try:
        judged({"A" * k for k in range(1, 200)} | {"B" + "A" * 150})
    finally:
        R.step = plain
    assert len(made) == 200


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    texts = ["Hello there.", "What?", "no end", "  \t", "", None, "Fine!\n ", "x" * 5000 + ".", "é ü.", "again", "tab\t"]
    out = []
    for conv in [*range(160), None]:
        turn = 0
        for _ in range(rnd.choice([1, 2, 4, 5, 8])):
            out.append((conv, turn if rnd.random() > 0.04 else None, rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rnd.choice(texts)))
            turn += rnd.choice([1, 1, 1, 2, 0])
    out += [(500, k, "user" if k % 2 else "assistant", texts[k % 3]) for k in range(700)]      # one conversation of many rows
    out += [(501, 3, "user", "Same.")] * 300                                                   # repeated rows
    return out


def test_against_brute_force(spark, rows):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, k string, Rid int").repartition(5)
    got = sorted(map(tuple, R.repair_report(df).collect()), key=str)
    assert got == brute(rows)


def test_rows_and_empty(spark):
    rows = [(1, 1, "system", "Be kind."), (1, 2, "assistant", "Hi."), (1, 3, "assistant", "Hi."), (2, 1, "user", " ")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    repair = R.Repair(df)
    got = sorted(tuple(r) for r in repair.rows.collect())
    assert got == [("v1", 0, "system", "Be kind.", False), ("v1", 1, "user", "", True), ("v1", 2, "assistant", "Hi.", False)]
    assert {r.k: (r.audit, r.cost, r.duplicate, r.blank) for r in repair.audits.collect()} == {"v1": ("KIKD", 5, 1, 0), "v2": ("D", 3, 0, 1)}
    assert R.repair_report(df.limit(0)).count() == 0
