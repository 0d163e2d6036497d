"""Connected components of a link table by alternating star contractions.

Every pass is two groupings with map-side minima and two joins, so a node with very many
links is never gathered. The links of each pass are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.llm.tables import Written


def _towards_smallest(links: DataFrame) -> DataFrame:
    """Large star: larger neighbours of a node link to the smallest node around it."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _from_larger(links: DataFrame) -> DataFrame:
    """Small star: a node and its smaller neighbours link to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link.

    ``links`` has columns a and b of one orderable type; nodes without links do not appear.
    """
    now = Written(links.where("a <> b").select("a", "b").distinct(), "links")
    before = None
    while True:
        state = now.df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == before:
            break
        before = tuple(state)
        large = Written(_towards_smallest(now.df), "links")
        now.drop()
        now = Written(_from_larger(large.df), "links")
        large.drop()
    roots = now.df.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.df.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
