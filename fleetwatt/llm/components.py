"""Connected components of undirected links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetwatt.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """node, root of ``links(a, b)``: the smallest node that each linked node reaches.

    Every round stores its links, so a lost executor costs at most one round.
    A node with many links is one row per task in the minima, and the skewed
    side of the join back, which adaptive execution splits. Rounds grow with the
    logarithm of the longest path. Links of a node to itself and repeats do not count.
    """
    stars = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    last = None
    while True:
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(stars.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # Large stars link each node to smaller ones only: a > b.
        down = large.where("a <> b")
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            down.join(lowest, "a")
            .select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
            .select("l.a", "l.b")
            .where("a <> b")
            .distinct()
        )
        stars = stored(small, "links")
        state = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == last:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        last = state
