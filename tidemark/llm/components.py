"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.checkpoints import cut


def _by_hub(edges: DataFrame, hub: DataFrame) -> DataFrame:
    """Every edge (a, b) with the smallest node around its ``a``; a hot ``a`` can be split."""
    return edges.join(hub, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours point to the smallest node around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    hub = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return _by_hub(both, hub).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    hub = down.groupBy("a").agg(F.min("b").alias("m"))
    links = _by_hub(down, hub).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return links.union(hub.select("a", F.col("m").alias("b"))).where("a <> b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is its component's smallest node.

    Alternates large-star and small-star steps until the edges no longer change,
    which takes a number of rounds that grows with the logarithm of the nodes.
    Each round is a few joins and partial aggregates; two numbers come to the
    driver. Self-loops and repeated edges change nothing; null ends are ignored.
    """
    edges = cut(edges.where("a <> b").distinct())
    state = _state(edges)
    while state[0]:
        edges = cut(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
