"""Connected components of a link table, as alternating star joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import settle

#: Alternating stars halve every path; no real graph comes near this many rounds.
MAX_ROUNDS = 60


def _lowest(links: DataFrame, node: str, other: str) -> DataFrame:
    """Smallest partner of each node, stored so that the join after it sees two plain tables."""
    return settle(links.groupBy(F.col(node).alias("node")).agg(F.min(other).alias("low")), "stars")


def _large_star(links: DataFrame) -> DataFrame:
    """Hang every larger partner of a node on the smallest partner the node has."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both, "a", "b").select("node", F.least("node", "low").alias("low"))
    return links.join(low, links["b"] == low["node"]).select("a", F.col("low").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller partners on the smallest of them."""
    low = _lowest(links, "a", "b")
    found = links.join(low, links["a"] == low["node"])
    return (
        found.select(F.col("b").alias("a"), F.col("low").alias("b"))
        .unionByName(low.select(F.col("node").alias("a"), F.col("low").alias("b")))
        .where("a > b")
        .distinct()
    )


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)`` that is not its component's smallest node.

    Links have no direction; loops, repeated links and nulls are ignored. Nodes without a row here are
    their own component. Every round is stored in the shared folder, so a lost executor costs one round,
    and hubs are aggregated before they are joined.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = settle(pairs, "links"), None
    for _ in range(MAX_ROUNDS):
        state = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        current = settle(_small_star(settle(_large_star(current).distinct(), "links")), "links")
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
