"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.store import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    others = down.join(least, "a").filter(F.col("b") != F.col("m"))
    return others.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for each node of the links ``a``, ``b`` other
    than the smallest ones themselves.

    Each round is a few joins on the nodes, written to the shared folder; the driver sees a count
    and a checksum. Minima are combined before every shuffle, so a node with very many links is no
    single task's. The number of rounds grows with the logarithm of the number of nodes.
    """
    links = links.select("a", "b").filter(F.col("a") != F.col("b"))
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    checksum = F.expr("coalesce(sum(cast(xxhash64(a, b) as decimal(20))), 0)")
    before = links.agg(F.count("*"), checksum).first()
    while True:
        links = stored(_small_star(_large_star(links)).distinct(), "links")
        now = links.agg(F.count("*"), checksum).first()
        if now == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = now
