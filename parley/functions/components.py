"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.sources.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that it reaches, for every node of the edges
    ``a``, ``b``.

    Every round hangs each node's greater neighbours, then its smaller ones, from the smallest of
    them; paths halve, so the rounds grow with the logarithm of their length. Minima are combined
    before they move. A round is a written table; the driver sees two numbers.
    """
    links = edges.select(F.greatest("a", "b").alias("up"), F.least("a", "b").alias("down")).distinct()
    links = stored(links, "edges")
    nodes = links.select("up").union(links.select("down")).distinct()
    mark = None
    while True:
        both = links.union(links.select("down", "up")).toDF("at", "other")
        low = both.groupBy("at").agg(F.min("other").alias("low")).select("at", F.least("at", "low").alias("low"))
        hung = both.join(low, "at").filter("other > at").select(F.col("other").alias("up"), F.col("low").alias("down"))
        low = hung.groupBy("up").agg(F.min("down").alias("low"))
        aside = hung.join(low, "up").filter("down > low").select(F.col("down").alias("up"), F.col("low").alias("down"))
        links = stored(aside.union(low).toDF("up", "down").distinct(), "edges")
        now = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("up", "down"))).first()
        if now == mark:
            break
        mark = now
    found = nodes.toDF("node").join(links.select(F.col("up").alias("node"), "down"), "node", "left")
    return found.select("node", F.coalesce("down", "node").alias("component"))
