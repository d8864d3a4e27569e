"""Connected components of a link table by repeated hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakelayers.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is the smallest node reachable.

    Each round hooks every node to its smallest neighbour, flattens the trees by pointer jumping, and replaces
    the links by links between roots. At least half of the linked nodes vanish per round, so the number of
    rounds grows with the logarithm of the links. Rows are reduced by key before every shuffle and each round
    ends in a written table. Loops and repeated links do not matter, links with a null end are ignored, an
    empty table gives an empty table.
    """
    edges = _tidy(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")))
    edges = stored(edges, "links")
    found = None
    while not edges.isEmpty():
        parents = stored(_flat(_hooked(edges)), "roots")
        if found is None:
            found = parents
        else:
            step = parents.select(F.col("node").alias("component"), F.col("component").alias("_next"))
            found = stored(
                found.join(step, "component", "left").select(
                    "node", F.coalesce("_next", "component").alias("component")
                ),
                "components",
            )
        a = parents.select(F.col("node").alias("a"), F.col("component").alias("_a"))
        b = parents.select(F.col("node").alias("b"), F.col("component").alias("_b"))
        moved = edges.join(a, "a").join(b, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
        edges = stored(_tidy(moved), "links")
    return edges.sparkSession.createDataFrame([], "node long, component long") if found is None else found


def _tidy(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _hooked(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("other"))
    return least.select("node", F.least("node", "other").alias("component"))


def _flat(parents: DataFrame) -> DataFrame:
    """Follow parents until every node points at a root; the depth halves with each step."""
    while True:
        parents = stored(parents, "parents")
        up = parents.select(F.col("node").alias("component"), F.col("component").alias("_up"))
        up = up.filter(F.col("component") != F.col("_up"))
        step = parents.join(up, "component", "left")
        if step.filter(F.col("_up").isNotNull()).isEmpty():
            return parents
        parents = step.select("node", F.coalesce("_up", "component").alias("component"))
