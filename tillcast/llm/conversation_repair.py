"""Conversation structure repair over a suffix-shared automaton.

Each row of a conversation becomes one symbol (class of its role, first
fault); a conversation's symbols in order are its signature.  Equal
signatures are one row, however many conversations have them.

The automaton is minimised from the end: its nodes are the distinct suffixes
of all signatures, and a node's only way on is its suffix without the first
symbol.  Signatures are sorted by their reversed text, so that a task meets
the nodes of its range in depth-first order: the nodes shared with the
signature before are still on its stack, only the others are made.  A node
holds, for each state of the role grammar, the cost to go and the first edit
of the best audit suffix; the rest of that audit hangs on the node below.

Memory: a task holds one stack (as long as its longest signature), never a
conversation's texts.  Rows of one conversation are numbered over sorted
ranges, so that a conversation may hold any share of all rows.  The hash of a
repaired conversation is serial by its nature: a task streams the rows of one
conversation after the other.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import SPACE, pick, ready, stored
from tillcast.operators.ranking import numbered_ranges

# Costs of the edits and of a truncated row that stays.
RETYPE, DROP, ADD, CUT = 2, 3, 2, 1
# The grammar (s?(ua)+)?: nothing yet, after s, after u, after ua.
EMPTY, SYSTEM, USER, PAIR = range(4)
ON_USER = {EMPTY: USER, SYSTEM: USER, PAIR: USER}
ENDS = (0, 2 * ADD, ADD, 0)                # cost to go at the end: "", "II", "I", ""
END_AUDIT = ("", "II", "I", "")
ROLES, FAULTS = "suax", "obdt"             # x: any other initial; ok, blank, duplicate, truncated
LEGAL = {"su", "ua", "au"}


def symbol(role: str, fault: str) -> str:
    return chr(65 + 4 * ROLES.index(role) + FAULTS.index(fault))


@cache
def step(sym: str, below: tuple[int, ...]) -> tuple[int, tuple[int, ...], str]:
    """A node over a node with the costs ``below`` (by grammar state): what all
    costs exceed the returned ones by, the costs, the first edit of each
    state.  Costs are kept relative to their least, of which there are few
    vectors, so a step is looked up."""
    at = ord(sym) - 65
    role, fault = ROLES[at // 4], FAULTS[at % 4]
    extra = CUT * (fault == "t")
    plain = []
    for state in range(4):
        ways = [(DROP + below[state], "D")]
        if fault in "ot":
            to = ON_USER.get(state, PAIR)
            wanted = "a" if state == USER else "u"
            ways.append((RETYPE + extra + below[to], "R"))
            if role == wanted:
                ways.append((extra + below[to], "K"))
            if role == "s" and state == EMPTY:
                ways.append((extra + below[SYSTEM], "K"))
        plain.append(min(ways))
    best = [min(plain[state], (ADD + plain[ON_USER.get(state, PAIR)][0], "I")) for state in range(4)]
    least = min(c for c, _ in best)
    return least, tuple(c - least for c, _ in best), "".join(e for _, e in best)


def audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures (column sig), sorted by their reversed text; returns audit,
    cost, adjacent rows with illegal roles, and of each repaired row the
    number of its source row (-1: none) and its role (k: its own)."""
    before, costs, edits, base, illegal = "", [tuple(ENDS)], [""], array("q", [0]), array("q", [0])
    for batch in batches:
        out: list[list] = [[] for _ in range(6)]
        for sig in batch.column("sig").to_pylist():
            back = sig[::-1]
            same = shared(before, back)
            for stack in (costs, edits, base, illegal):
                del stack[same + 1:]
            for k in range(same, len(back)):
                more, rel, first = step(back[k], costs[-1])
                costs.append(rel)
                edits.append(first)
                base.append(base[-1] + more)
                role = ROLES[(ord(back[k]) - 65) // 4]
                pair = k > 0 and role + ROLES[(ord(back[k - 1]) - 65) // 4] not in LEGAL
                illegal.append(illegal[-1] + pair)
            before = back
            audit, source, role = walk(back, edits)
            for col, value in zip(out, (sig, audit, base[-1] + costs[-1][EMPTY], illegal[-1], source, role), strict=True):
                col.append(value)
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                                         names=["sig", "audit", "cost", "illegal", "source", "out_role"])


def shared(x: str, y: str) -> int:
    """Length of the common start, by halving."""
    low, high = 0, min(len(x), len(y))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if x[low:mid] == y[low:mid] else (low, mid - 1)
    return low


def walk(back: str, edits: list[str]) -> tuple[str, list[int], str]:
    """Down from the top node: the audit and the rows that it leaves."""
    state, audit, source, out_role = EMPTY, [], [], []
    node = len(back)
    while node > 0:
        edit = edits[node][state]
        audit.append(edit)
        if edit == "D":
            node -= 1
            continue
        row = len(back) - node
        system = edit == "K" and state == EMPTY and (ord(back[node - 1]) - 65) // 4 == ROLES.index("s")
        out_role.append("k" if edit == "K" else "a" if state == USER else "u")
        source.append(-1 if edit == "I" else row)
        node -= edit != "I"
        state = SYSTEM if system else ON_USER.get(state, PAIR)
    audit.append(END_AUDIT[state])
    for _ in END_AUDIT[state]:
        out_role.append("a" if state == USER else "u")
        source.append(-1)
        state = ON_USER.get(state, PAIR)
    return "".join(audit), source, "".join(out_role)


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the newline-joined lines of each key; rows arrive sorted by
    key and position."""
    key, state = None, None
    for batch in batches:
        keys, found = [], []
        for k, line in zip(batch.column("k").to_pylist(), batch.column("line").to_pylist(), strict=True):
            if k != key:
                if state is not None:
                    keys.append(key)
                    found.append(state.hexdigest())
                key, state = k, hashlib.sha256(line.encode())
            else:
                state.update(b"\n" + line.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(found, pa.string())], names=["k", "sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([state.hexdigest()], pa.string())], names=["k", "sha256"])


def conv_key(col: str) -> Column:
    """Text of an id that is never null."""
    return F.when(F.col(col).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(col).cast("string")))


class Repair:
    """Repair of the conversations of a table of rows (conv_id, turn, role, text).

    ``audits``: a row per conversation (key k): gaps, blank, duplicate,
    truncated, illegal, cost, audit and the source and role of each row that
    is left.  ``rows``: the repaired rows (k, position, role, text, edited).
    ``sha256``: k and the hash of its repaired ``role:text`` lines.

    A null conv_id is a conversation of its own, a null role or text is one
    space, a null turn comes first.  Rows of one turn stand by role, then by
    a hash of their text; equal rows are adjacent.  A row's role class is its
    first character; an empty role is of no class.  An empty table gives
    empty tables.
    """

    def __init__(self, rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text"):
        ready(rows.sparkSession)
        flat = pick(rows, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
        text, role = F.coalesce(F.col("text").cast("string"), F.lit(" ")), F.coalesce(F.col("role").cast("string"), F.lit(" "))
        body = F.rtrim(F.col("text"), F.lit(SPACE))
        flat = (flat.select(conv_key("conv_id").alias("k"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
                .withColumns({"rid": F.monotonically_increasing_id(), "th": F.unhex(F.sha2("text", 256)),
                              "fault": F.when(body == "", "b").when(F.substring(body, -1, 1).isin(".", "!", "?"), "o").otherwise("t")}))
        self.input = stored(flat, "turns")
        self.runs = self._numbered()
        self.audits = stored(self._audits(), "audits")

    def _numbered(self) -> DataFrame:
        """Equal rows of a turn as one run, with its symbols and the number of
        its first row in the conversation."""
        runs = self.input.groupBy("k", "turn", "role", "th", "fault").agg(F.count("*").alias("n"), F.min("rid").alias("rid"))
        runs = stored(runs, "runs")
        when = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
        first = runs.groupBy("k", "role", "th").agg(F.min(when).alias("first"))
        seen = runs.join(first, ["k", "role", "th"]).withColumn("again", (F.col("first") != when) & (F.col("fault") != "b"))
        initial = F.substring("role", 1, 1)
        role_at = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
        fault_at = lambda c: F.when(c == "o", 0).when(c == "b", 1).when(c == "d", 2).otherwise(3)
        sign = lambda c: F.char(65 + 4 * role_at + fault_at(c))
        head = F.when(F.col("again"), "d").otherwise(F.col("fault"))
        rest = F.when(F.col("fault") == "b", "b").otherwise("d")
        seen = seen.select("k", "turn", "role", "th", "rid", "n", F.concat(sign(head), F.repeat(sign(rest), (F.col("n") - 1).cast("int"))).alias("symbols"))
        ranged = numbered_ranges(seen, ["k", "turn", "role", "th"])
        inside = Window.partitionBy("k", "_pid").orderBy("_lr").rowsBetween(Window.unboundedPreceding, -1)
        return ranged.withColumn("place", F.coalesce(F.sum("n").over(inside), F.lit(0)))

    def _pieces(self) -> DataFrame:
        """A conversation's symbols by range, and the rows in the ranges before:
        a conversation has one piece for each range that it lies in."""
        text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_lr", "symbols"))), lambda x: x["symbols"]), "")
        pieces = self.runs.groupBy("k", "_pid").agg(text.alias("piece"), F.sum("n").alias("rows"))
        before = Window.partitionBy("k").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
        return pieces.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))

    def _audits(self) -> DataFrame:
        self.pieces = stored(self._pieces(), "pieces")
        whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pid", "piece"))), lambda x: x["piece"]), "")
        convs = self.pieces.groupBy("k").agg(whole.alias("sig"))
        convs = stored(convs, "signatures")
        turns = self.runs.groupBy("k", "turn").agg(F.lit(1).alias("one")).groupBy("k").agg(
            F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
        sigs = stored(convs.groupBy("sig").agg(F.count("*").alias("conversations")), "distinct-signatures")
        order = F.reverse("sig")
        judged = (sigs.repartitionByRange(order).sortWithinPartitions(order).select("sig")
                  .mapInArrow(audits, "sig string, audit string, cost long, illegal long, source array<long>, out_role string"))
        of = lambda fault: F.length("sig") - F.length(F.translate("sig", "".join(symbol(r, fault) for r in ROLES), ""))
        judged = judged.withColumns({"blank": of("b").cast("long"), "duplicate": of("d").cast("long"), "truncated": of("t").cast("long")})
        return convs.join(stored(judged, "judged"), "sig").join(turns, "k").drop("sig")

    @property
    def rows(self) -> DataFrame:
        left = self.audits.select("k", "out_role", F.posexplode("source").alias("position", "place"))
        left = left.select("k", "position", "place", F.substring(F.col("out_role"), F.col("position") + 1, F.lit(1)).alias("to"))
        named = F.when(F.col("to") == "u", "user").otherwise("assistant")
        added = left.filter("place < 0").select("k", "position", named.alias("role"), F.lit("").alias("text"), F.lit(True).alias("edited"))
        found = self.runs.join(self.pieces.select("k", "_pid", "start"), ["k", "_pid"]).select("k", "rid", (F.col("start") + F.col("place")).alias("place"))
        kept = left.filter("place >= 0").join(found, ["k", "place"]).select("rid", "position", "to")
        kept = self.input.join(kept, "rid").select("k", "position", F.when(F.col("to") == "k", F.col("role")).otherwise(named).alias("role"),
                                                   "text", (F.col("to") != "k").alias("edited"))
        return kept.union(added)

    @property
    def sha256(self) -> DataFrame:
        lines = self.rows.select("k", "position", F.concat("role", F.lit(":"), "text").alias("line"))
        return lines.repartition("k").sortWithinPartitions("k", "position").select("k", "line").mapInArrow(digests, "k string, sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of ``conversations`` after the damage of the contract, by the
    CRC-32 of ``conv_id:turn`` modulo 20 (a null is one space)."""
    flat = pick(conversations, conv_id="conv_id", turn="turn", role="role", text="text")
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    flat = flat.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    flat = flat.filter("kind <> 0").withColumns({
        "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
        "copy": F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))})
    return flat.select("conv_id", "turn", "role", "text")


def repair_report(conversations: DataFrame) -> DataFrame:
    """One row per conv_id of ``conversations``: faults, cost and audit of its
    damaged rows and the hash of the repaired ones.  A conversation without
    rows after the damage has zeros, an empty audit and the hash of nothing."""
    ready(conversations.sparkSession)
    repair = Repair(damaged(conversations))
    every = pick(conversations, conv_id="conv_id").distinct().withColumn("k", conv_key("conv_id"))
    out = every.join(repair.audits.drop("source", "out_role"), "k", "left").join(repair.sha256, "k", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
