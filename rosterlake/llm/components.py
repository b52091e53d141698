"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterlake.llm.common import spread_join
from rosterlake.session import cut


def connected(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; the root is the smallest node.

    ``links`` has two columns a and b. Every round hangs each node's neighbours
    on the smallest node it knows, first the larger neighbours, then the
    smaller; only minima travel, and rounds are written tables.
    """
    links = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct())
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = spread_join(both, least, ["a"]).where("b > a").select(
            F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = cut(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = spread_join(large, least, ["a"])
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        small = cut(small)
        if small.exceptAll(links).isEmpty() and links.exceptAll(small).isEmpty():
            return small.select(F.col("a").alias("node"), F.col("b").alias("root"))
        links = small
