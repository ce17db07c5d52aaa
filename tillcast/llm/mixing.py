"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down a tree, say domain - language - source, in the
proportion of the weights at each level.  A node can give no more than its
documents have in ``max_epochs`` epochs; what it falls short of goes to its
siblings first, and beyond the parent only when all of them are full (a
parent gets no more than its children can give).  Each leaf then reads its
documents in a seeded order, epoch after epoch, up to its budget.

DataFrame functions only.  Counting by text happens once; the place where
a leaf's last epoch ends is found by descending the order's hash two hex
digits at a time, so that no task sorts a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import WORD, numbered, place, ready, stored

MAX_EPOCHS = 4
SEED = 17
DESCENTS = 3   # two hex digits each: 256 ** 3 slices of a leaf

WIDE = "decimal(38,0)"


def weight_of(name: Column, weights: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for k, w in weights.items():
        out = F.when(name == k, F.lit(w)).otherwise(out)
    return out


def share_out(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Water filling below each parent.  nodes: parent columns, name, cap,
    weight (1 or more), pool (the parent's budget, no more than its caps).
    Adds budget, whose sum by parent is pool exactly."""
    group = Window.partitionBy(*[F.col(c) for c in parent]) if parent else Window.partitionBy(F.lit(0))
    order = group.orderBy((F.col("cap").cast("double") / F.col("weight").cast("double")).asc(), F.col(name).asc())
    down, up = order.rowsBetween(Window.currentRow, Window.unboundedFollowing), order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n = nodes.withColumns({"w_rest": F.sum("weight").over(down), "c_before": F.coalesce(F.sum("cap").over(up), F.lit(0).cast(WIDE))})
    # full: its part of what those with less supply for their weight leave is all it has
    n = n.withColumn("full", (F.col("pool") - F.col("c_before")).cast(WIDE) * F.col("weight") >= F.col("cap").cast(WIDE) * F.col("w_rest"))
    n = n.withColumns({
        "left": (F.col("pool") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group), F.lit(0))).cast(WIDE),
        "w_open": F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(group), F.lit(0)).cast(WIDE),
        "w_upto": F.coalesce(F.sum(F.when(~F.col("full"), F.col("weight"))).over(upto), F.lit(0)).cast(WIDE)})
    part = F.expr("left * w_upto div w_open - left * (w_upto - weight) div w_open")
    n = n.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(part.cast(WIDE)).cast(WIDE))
    return n.drop("w_rest", "c_before", "full", "left", "w_open", "w_upto")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: list[dict[str, int]], default: int, share: tuple[int, int], max_epochs: int) -> DataFrame:
    """leaves: levels and supply.  Adds budget.  share: budget of the whole as a
    fraction of the supply of all leaves with a weight."""
    weighed = leaves
    for name, w in zip(levels, weights, strict=True):
        weighed = weighed.withColumn(f"w_{name}", weight_of(F.col(name), w, default).cast(WIDE))
    some = F.lit(True)
    for name in levels:
        some = some & (F.col(f"w_{name}") > 0)
    weighed = weighed.filter(some & (F.col("supply") > 0)).withColumn("cap", (F.col("supply") * max_epochs).cast(WIDE))
    above, parents = None, []
    for name in levels:
        here = weighed.groupBy(*parents, name).agg(F.sum("cap").cast(WIDE).alias("cap"), F.max(f"w_{name}").alias("weight"))
        if above is None:
            whole = weighed.agg((F.sum("supply") * share[0]).cast(WIDE).alias("n"), F.sum("cap").cast(WIDE).alias("most")).select(
                F.least(F.expr(f"n div {share[1]}").cast(WIDE), "most").alias("pool"))
            here = here.join(F.broadcast(whole))   # one row
        else:
            here = here.join(above.select(*parents, F.col("budget").alias("pool")), parents)
        above, parents = share_out(here, parents, name), [*parents, name]
    return weighed.select(*levels, "supply").join(above.select(*levels, "budget"), levels)


def mix_to_weights(docs: DataFrame, levels: list[str], weights: list[dict[str, int]], share: tuple[int, int] = (1, 1),
                   max_epochs: int = MAX_EPOCHS, seed: int = SEED, default: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the mixture takes, once for each epoch in which
    it does, with all columns and epoch, n_tokens (words of the text) and
    take_tokens (fewer than n_tokens where the budget ends within a
    document).  New columns replace ones of the same name.

    levels: the columns of the tree, root first.  weights: for each level,
    whole-number weights by node; nodes that aren't listed weigh
    ``default``, weight 0 leaves a node out.  share: the budget, as a
    fraction of the tokens of all nodes that aren't left out.  Null names
    are the node ''.  Null texts and texts without a word are never taken.
    Rows that repeat an id (or have none) stand at one place in the order;
    where the budget ends among them, each is cut at what was left.  An
    empty table gives an empty table.
    """
    ready(docs.sparkSession)
    ident, text = f"c{place(docs, id_col)}", f"c{place(docs, text_col)}"
    tree = [f"_t{k}" for k in range(len(levels))]
    flat = numbered(docs).withColumns({t: F.coalesce(F.col(f"c{place(docs, c)}").cast("string"), F.lit("")) for t, c in zip(tree, levels, strict=True)} | {
        "_n": F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")})
    narrow = stored(flat.filter("_n > 0").select(*tree, F.col(ident).cast("string").alias("_id"), "_n"), "tokens")
    leaves = narrow.groupBy(*tree).agg(F.sum("_n").alias("supply"))
    plan = leaf_budgets(leaves, tree, weights, default, share, max_epochs)
    plan = stored(plan.select(*tree, F.expr("budget div supply").cast("int").alias("_full"),
                              F.expr("budget - (budget div supply) * supply").cast("long").alias("_rest")), "plan")
    last = stored(narrow.join(plan.filter("_rest > 0"), tree).withColumn("_h", seat(seed)).select(*tree, "_h", "_n", "_rest"), "last")
    cut = stored(descend(last, tree, 0), "cut")
    for depth in range(1, DESCENTS):
        here = last.drop("_rest").withColumn("_p", F.substring("_h", 1, 2 * depth)).join(cut, [*tree, "_p"])
        cut = stored(descend(here, tree, depth), "cut")
    rows = last.drop("_rest").withColumn("_p", F.substring("_h", 1, 2 * DESCENTS)).join(cut, [*tree, "_p"])
    units = rows.groupBy(*tree, "_rest", "_h").agg(F.sum("_n").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*tree).orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    end = (units.withColumn("_before", before).filter("_before < _rest").groupBy(*tree)
           .agg(F.max(F.struct("_h", (F.col("_rest") - F.col("_before")).alias("_take"))).alias("_end"))
           .select(*tree, F.col("_end._h").alias("_end_h"), F.col("_end._take").alias("_end_take")))
    plan = stored(plan.join(end, tree, "left"), "plan")
    out = flat.filter("_n > 0").join(plan, tree).withColumn("_h", F.when(F.col("_rest") > 0, seat(seed, ident)))
    out = out.withColumn("_more", F.coalesce((F.col("_h") <= F.col("_end_h")).cast("int"), F.lit(0)))
    out = out.filter(F.col("_full") + F.col("_more") > 0).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.col("_full") + F.col("_more"))))
    cut_here = (F.col("epoch") > F.col("_full")) & (F.col("_h") == F.col("_end_h"))
    new = ["epoch", "n_tokens", "take_tokens"]
    keep = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in new]
    return out.select(*keep, "epoch", F.col("_n").alias("n_tokens"), F.when(cut_here, F.least("_n", "_end_take")).otherwise(F.col("_n")).alias("take_tokens"))


def seat(seed: int, ident: str = "_id") -> Column:
    """Place of a document in the epoch after the full ones: a hash in hex."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("_full") + 1).cast("string"), F.coalesce(F.col(ident).cast("string"), F.lit(""))))


def descend(here: DataFrame, tree: list[str], depth: int) -> DataFrame:
    """here: by leaf the documents whose hash begins with the leaf's prefix of
    2 * depth digits, and the tokens that are still to be taken among them.
    The prefix of two digits more in which the leaf's budget ends, and the
    tokens to be taken there."""
    slices = here.groupBy(*tree, "_rest", F.substring("_h", 1, 2 * depth + 2).alias("_q")).agg(F.sum("_n").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*tree).orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (slices.withColumn("_before", before).filter("_before < _rest AND _before + _n >= _rest")
            .select(*tree, F.col("_q").alias("_p"), (F.col("_rest") - F.col("_before")).alias("_rest")))
