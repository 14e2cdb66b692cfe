"""Connected components of a link table, without gathering links anywhere."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depthmill.session import written


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from every node of (a, b), for nodes that have a link.

    Alternates two star steps, each of which hangs neighbours on the smallest node seen, until nothing changes. Minima are
    aggregated before they are joined, and every round is written to the shared folder, so lineage stays short.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    seen = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        edges = written(hung.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v"))).distinct(), "stars")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == (now["n"], now["h"]):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
        seen = (now["n"], now["h"])
