"""Connected components of a link table, by repeated contraction on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import checkpointed


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (columns a, b); one root per component.

    In each round every node of the remaining graph hooks onto the neighbour, or itself,
    that comes first in a hashed order of that round, links are rewritten to the hooked
    nodes, and loops and repeats go. The hash keeps chains from shrinking one node at a
    time, so a number of rounds in the logarithm of the node count is expected. Only
    aggregates combined before the shuffle and equi-joins with one row per node on one
    side are used, so a node with very many links is no hot spot. NULL ends and loops of
    the input are ignored; an empty table gives an empty table.
    """
    pair = F.array("a", "b")
    left = checkpointed(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.array_min(pair).alias("a"), F.array_max(pair).alias("b")).distinct()
    )
    hooks, seed = [], 0
    while not left.isEmpty():
        seed += 1
        ends = left.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        order = lambda node: F.struct(F.xxhash64(F.lit(seed), node).alias("h"), node.alias("n"))
        hook = checkpointed(
            ends.groupBy(F.col("e.a").alias("node")).agg(F.min(order(F.col("e.b"))).alias("other"))
            .select("node", F.least(order(F.col("node")), F.col("other")).alias("first"))
            .select("node", F.col("first.n").alias("root"))
        )
        hooks.append(hook)
        moved = (
            left.join(hook.toDF("a", "root_a"), "a").join(hook.toDF("b", "root_b"), "b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
            .where("a <> b").distinct()
        )
        left = checkpointed(moved)
    if not hooks:
        return left.select(F.col("a").alias("node"), F.col("a").alias("root"))
    found = hooks[0]
    for hook in hooks[1:]:
        later = hook.toDF("root", "later")
        found = found.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return found
