"""Connected components over an edge table, as joins and grouped minima.

Alternating large-star and small-star steps (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): each step links the neighbours
of a node to the least of them.  The edges of a component end as a star
around its least node.  No group is gathered: a step is a grouped minimum
(combined before the shuffle) and a join on the node, whose hot keys
adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import scratch


def _write(df: DataFrame, what: str) -> DataFrame:
    path = scratch(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    """edges (a > b): each neighbour above a node links to the node's least
    neighbour (itself included)."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a > b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """edges (a > b): the neighbours below a node, and the node, link to the
    least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    down = edges.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return down.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of an edge, component is the least node
    that it reaches.  Edges may repeat, point either way or to themselves;
    edges with a null end are left out."""
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), (F.col(a).isNotNull() & F.col(b).isNotNull()).alias("ok")).filter("ok").drop("ok")
    e = _write(e.distinct(), "edges")
    nodes = e.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("component"))
    now = e.filter("a > b")
    before = None
    while True:
        now = _write(_small_star(_large_star(now)), "star")
        # a star forest doesn't change any more; the sums tell whether it did
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    star = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = star.select(F.col("component").alias("node"), "component").distinct()
    return star.union(roots).union(nodes).groupBy("node").agg(F.min("component").alias("component"))
