"""Connected components of a graph in a DataFrame, by alternating star operations.

Edges are pairs of longs. A large star links every larger neighbour of a node to its
smallest neighbour, a small star the smaller ones; after a few rounds every node is
linked to the smallest node of its component. Sums are formed before shuffles, and each
round is written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskflow.sources.tables import written


def _star(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of every u with all its v: each v and u are linked to the smallest of both."""
    least = edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return edges.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def roots(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; root is the smallest node reachable."""
    e = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = _state(e)
    for _ in range(most_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = _star(large)
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            down.select("u", F.col("m").alias("v"))
        )
        e = written(small.where("u <> v").distinct(), "edges")
        now = _state(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = e.groupBy("u").agg(F.min("v").alias("root"))
    return stars.select(F.col("u").alias("node"), "root").unionByName(
        stars.select(F.col("root").alias("node"), "root").distinct()
    )


def survivors(keyed: DataFrame, nodes: DataFrame, linked: DataFrame) -> DataFrame:
    """The ``row`` of ``keyed`` with the smallest ``key`` of each component, as columns.

    ``keyed`` holds whole rows as a struct beside their key, so their columns may have any names;
    ``nodes`` has the smallest ``key`` of each ``node``, ``linked`` the ``root`` of linked nodes.
    """
    best = nodes.join(linked, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(
        F.min("key").alias("key")
    ).select("key")
    return keyed.join(best, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
