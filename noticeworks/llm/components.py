"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.common import fresh, scratch, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: the smallest node each one reaches; nodes are strings, links undirected.

    Each round ties every node's greater neighbours to its smallest one, then does the same
    with the smaller ones; what remains in the end are stars around the roots. Rounds grow with
    the logarithm of the longest chain. Each is written to the shared folder; the driver sees
    a count and a checksum. Nodes without links are absent; null nodes are ignored.
    """
    with scratch(links.sparkSession):
        edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
        edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        before = None
        while True:
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select(fresh(F.col("u")).alias("u"), F.least("u", "m").alias("m"))
            greater = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
            # now every link goes from a node to a smaller one
            smallest = greater.groupBy("u").agg(F.min("v").alias("m")).select(fresh(F.col("u")).alias("u"), "m")
            tied = greater.join(smallest, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            edges = written(tied.select("e.*").where("u <> v").distinct(), "edges")
            now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if now == before:
                break
            before = now
        stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        return written(stars, "components", kept=True)
