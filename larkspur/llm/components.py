"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import materialise


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(a, b) links of any orderable type -> (node, component), the smallest node of each component.

    Each round hangs the larger neighbours of every node under its smallest
    one, then the smaller ones.  Both halves aggregate before they shuffle
    and join on the node, so a node with very many links is split by
    adaptive execution.  A round is written to the shared folder.  Nodes
    appear only if linked; a null end or a link to itself counts as no link.
    No links give an empty table.  Raises if ``rounds`` are not enough,
    which needs a chain longer than any memory.
    """
    low, high = F.least("a", "b"), F.greatest("a", "b")
    edges = materialise(links.where("a <> b").select(high.alias("a"), low.alias("b")).distinct(), "links")
    state = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        hung = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hung = hung.where("a <> b").distinct()
        least = hung.groupBy("a").agg(F.min("b").alias("m"))
        small = hung.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        edges = materialise(small.where("a <> b").distinct(), "links")
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        state = seen
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
