"""Connected components of an undirected graph, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpanel.llm.tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: every node links its larger neighbours to the least node it
    knows; small star: every node links its smaller neighbours and itself to it."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
    return linked.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): the least node it reaches.

    Each round keeps its edges in the shared folder; rounds grow with the
    logarithm of the graph, and a node's neighbours are never in one row."""
    edges = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u != v").distinct(), "edges")
    before = None
    while True:
        edges = stored(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
