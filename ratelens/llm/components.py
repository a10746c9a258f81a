"""Connected components of a link table, by alternating stars.

Every round replaces each node's links by links to its smallest neighbour
(first among the larger neighbours, then among the smaller ones) until
nothing changes: all that is left is one star per component.  Rounds grow
with the logarithm of the longest chain; each writes the remaining links to
the shared checkpoint folder.  Only two numbers per round reach the driver.
A node with very many links is reduced by partial aggregates and a join whose
hot partition Spark can split; no node's links are ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """(a > b): every larger neighbour of a node now hangs on the node's
    smallest neighbour (or itself)."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return (both.join(low, "u").where("v > u")
            .select(F.col("v").alias("a"), F.col("low").alias("b")).distinct())


def _small_star(links: DataFrame) -> DataFrame:
    """(a > b): a node and its smaller neighbours hang on the smallest."""
    low = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = (links.join(low, "a").where("b > low")
             .select(F.col("b").alias("a"), F.col("low").alias("b")))
    return moved.unionAll(low.select("a", F.col("low").alias("b"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of any sortable type -> ``(node, component)``: every
    node that has a link to another one, with the smallest node reachable.

    Self-links, repeated links and links with a NULL end are ignored; an
    empty table gives an empty result.  Nodes without links are not listed.
    """
    pairs = (links.where("a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = cut_lineage(pairs)
    seen = None
    while True:
        digest = state.agg(F.count(F.lit(1)),
                           F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(digest) == seen:
            break
        seen = tuple(digest)
        if not digest[0]:
            break
        state = cut_lineage(_small_star(_large_star(state)))
    roots = state.select(F.col("b").alias("node")).distinct()
    return (state.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionAll(roots.select("node", F.col("node").alias("component"))))
