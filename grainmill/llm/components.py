"""Connected components of an edge table, by rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from grainmill.session import materialise

MAX_ROUNDS = 100


def _stars(edges: DataFrame, larger: bool) -> DataFrame:
    """Hang each node's neighbours (all larger ones, or all smaller ones) on the least of them."""
    if larger:
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select("a", "b")  # a > b in every stored edge
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    hung = both.join(least, "a")
    if larger:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a and b, of one ordered type).

    The component is its smallest node. Edges with a null end and loops say nothing and are left
    out; a node that has no others does not come back. Rounds alternate between hanging larger
    neighbours and smaller ones on the least neighbour until the edges stay the same; each is
    written to the shared folder, so no lineage grows and no label reaches the driver. A node of
    very many edges meets them in joins whose hot keys Spark can split, and in partial minima.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = materialise(edges, "edges"), None
    for _ in range(MAX_ROUNDS):
        edges = materialise(_stars(materialise(_stars(edges, True), "edges"), False), "edges")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
        if now == before:
            members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            return members.unionByName(roots)
        before = now
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
