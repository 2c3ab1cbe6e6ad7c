"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import common


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every neighbour above u to the least of u and its neighbours."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(common.stored(least, "star-least"), "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link u and its neighbours below to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = common.stored(down.groupBy("u").agg(F.min("v").alias("m")), "star-least")
    return (down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))))


def _print(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of one ordered type to ``(node, root)``: root is the
    least node reachable.  Nodes without an edge to another are absent.

    Every round is two joins and two aggregates whose results are written to
    the shared folder; the number of rounds grows with the logarithm of the
    graph, not with its diameter.  The driver sees one count and checksum a
    round."""
    edges = common.stored(edges.select("u", "v").filter("u <> v").distinct(), "star-edges")
    seen = _print(edges)
    while seen[0]:
        edges = common.stored(_small_star(common.stored(_large_star(edges).distinct(), "star-large"))
                              .distinct(), "star-small")
        now = _print(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
