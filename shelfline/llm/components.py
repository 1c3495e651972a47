"""Connected components of a graph too large for one machine, by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.base import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = written(least, "least")  # so that both sides of the join are dealt for it, and a hot node's rows split
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """Rows (u, v) for each node u that isn't the least of its component, with that least node v.

    edges: u, v of one orderable type. Each round is written, and its rows are
    at most as many as the edges; rounds grow with the logarithm of the
    longest path. Grouping takes minima ahead of its shuffle; they are written
    before they are joined, as adaptive execution splits a hot node's rows only
    where no grouping sits on either side's shuffle.
    """
    edges = written(edges.where("u != v").distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v"))).first()
        if state == before or not state[0]:
            return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        before = state
        larger = written(_large_star(edges).where("u != v").distinct(), "larger")
        edges = written(_small_star(larger).where("u != v").distinct(), "edges")
