"""Connected components of a table of links, by alternating large-star and small-star steps.

Each step is a grouped minimum (combined before the shuffle) and a join on the same key, so a vertex with
very many links is pre-aggregated and its join can be split by AQE.  Every round is a table in the shared
folder; only a count and a checksum reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factlake.session import materialize


def _sum(df: DataFrame) -> tuple[int, int]:
    row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (smallest node it reaches) of every node of ``links(a, b)``.

    Direction, repeats and loops do not matter; rows with a null end link nothing.
    """
    edges = links.select(F.least("a", "b").alias("b"), F.greatest("a", "b").alias("a")).where("a IS NOT NULL AND b IS NOT NULL AND a != b")
    edges = materialize(edges.select("a", "b").distinct())  # a > b throughout
    seen = _sum(edges)
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: every greater neighbour points to the smallest one
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        # small star: the node and its smaller neighbours point to the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))
        edges = materialize(small.where("a != b").distinct())
        now = _sum(edges)
        if now == seen:
            break
        seen = now
    leaves = edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.union(roots)
