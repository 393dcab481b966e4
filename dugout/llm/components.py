"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import settle


def _both(links: DataFrame) -> DataFrame:
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.unionByName(back)


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = _both(links)
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return (
        both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        .filter("a <> b").distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that links lead to, for all nodes but the roots.

    ``links`` has two long columns ``a`` and ``b`` in either order, repeats and self-links
    allowed; links with a NULL are dropped. Large-star and small-star steps alternate until
    the links are stars; the number of rounds grows with the logarithm of a chain's length.
    A round never has more rows than there are links, keeps the links as a table in the
    scratch folder, and only a row count and a checksum come to the driver.
    """
    ordered = links.select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    ).where("a is not null and b is not null and a <> b")
    links = settle(_small_star(ordered), "links")
    last = None
    while True:
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == last or not state[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = state
        links = settle(_small_star(_large_star(links)), "links")
