"""Connected components of a link table, by alternating stars.

Each round points every node's larger neighbours at its smallest neighbour
(large star), then its smaller ones (small star), until nothing changes; links
end as stars around the smallest node.  Only aggregates and equi-joins; each
round is written to the shared folder, so no lineage grows and a lost executor
repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from claimlake.llm import common
from claimlake.session import discard


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a stored table, with their number and the sum of their digests, taken as they are written."""
    seen = Observation()
    marks = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")).alias("h")
    edges = common.stored(edges.observe(seen, *marks), "links")
    return edges, (seen.get["n"], seen.get["h"])


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of the links with the smallest node it reaches. Loops and repeated links do
    no harm; nodes must not be null; no links give an empty table."""
    edges, mark = _written(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct())
    while True:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(down.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        old, (edges, now) = edges, _written(small)
        discard(old)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
