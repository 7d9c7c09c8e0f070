"""Connected components of a graph of any size, with DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspan.storage import settle


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie each node's larger (or smaller) neighbours to its smallest one.

    The smallest neighbour is an aggregate joined back, so a node with very many
    neighbours is combined in the map tasks and its rows stay spread.
    """
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min("b").alias("_m"))
        tied = both.join(near, "a").filter("b > a")
        return tied.select(F.col("b").alias("a"), F.least("a", "_m").alias("b"))
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    near = down.groupBy("a").agg(F.min("b").alias("_m"))
    tied = down.join(near, "a")
    return tied.select(
        F.explode(F.array(F.struct("a", F.col("_m").alias("b")),
                          F.struct(F.col("b").alias("a"), F.col("_m").alias("b")))).alias("e")
    ).select("e.a", "e.b")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b); the root is the smallest node.

    Large and small stars take turns until nothing changes, which takes a number of rounds
    that grows with the logarithm of the graph. Every round is written
    to shared storage, so that lineage stays short and no lost executor undoes a round.
    """
    def tidy(df: DataFrame) -> DataFrame:
        return settle(df.filter("a != b").distinct(), "stars")

    def mark(df: DataFrame):
        return df.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()

    now = tidy(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    seen = mark(now)
    while seen["n"]:
        now = tidy(_star(_star(now, large=True), large=False))
        before, seen = seen, mark(now)
        if before == seen:
            break
    # What is left are stars: (node, its component's smallest node).
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
