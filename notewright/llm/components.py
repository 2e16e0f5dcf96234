"""Connected components of a graph held in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import durable


def _to_smallest(edges: DataFrame, others: str) -> DataFrame:
    """Hook the neighbours of every node onto the smallest of them and the node itself.

    edges: (a, b). The smallest is found by an aggregate that combines per task and is joined back,
    so that a node with very many neighbours never stands in one row or one group.
    """
    smallest = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return edges.join(smallest, "a").where(others)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge; component is its smallest reachable node.

    edges: columns a and b of one ordered type, in any direction, repeats and loops allowed.
    Rounds of two star steps: larger neighbours hook onto a node's smallest neighbour, then the
    node and its smaller neighbours do. Every round goes to the shared folder. Ends when a round
    changes nothing; the number of rounds grows with the logarithm of the longest path.
    """
    state = durable(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            break
        before = now
        both = state.unionAll(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_smallest(both, "b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.distinct()
        hooked = _to_smallest(small, "b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        roots = small.groupBy("a").agg(F.min("b").alias("b"))
        state = durable(hooked.unionAll(roots).where("a <> b").distinct())
    roots = state.select(F.col("b").alias("node")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        roots.select("node", F.col("node").alias("component")))
