"""Connected components of a graph given as a table of edges.

Large-star and small-star rounds: in a large-star round each node's larger neighbours
are linked to its smallest neighbour, in a small-star round the smaller ones; both keep
the components, and after a few rounds (their number grows with the logarithm of the
longest path) every node is linked to the smallest node of its component. A node's
minimum is a partial aggregate and its neighbours meet it in a plain join, so a node with
very many neighbours is never gathered in one place. Each round is written to the shared
folder; only two sums tell the driver when nothing changes any more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import materialise


def _least(links: DataFrame) -> DataFrame:
    """The smallest neighbour of each node that has a smaller one."""
    return links.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to its smallest neighbour. (A node is the smaller
    end of the links to its larger neighbours, so each link moves its smaller end.)"""
    return links.join(_least(links), F.col("b") == F.col("u"), "left").select("a", F.coalesce("m", "b").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    least = _least(links)
    return (links.join(least, F.col("a") == F.col("u")).where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """edges: two long columns a, b. Returns (node, root) for every node that has an edge
    to another node; root is the smallest node of its component."""
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links = materialise(links, "links")
    before = None
    while True:
        links = materialise(_small_star(_large_star(links)), "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before or not now[0]:
            break
        before = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b")).distinct()
