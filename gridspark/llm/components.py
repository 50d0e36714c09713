"""Connected components of a link table, distributed."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step over links (u > v).  Large: every larger neighbour of a
    node is linked to the node's smallest neighbour (itself included); small:
    every smaller-or-equal neighbour is.  Minima are combined before the
    shuffle, and a node with very many neighbours meets one row of minima, so
    the join may split its links over tasks."""
    if large:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = links.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # links to a smaller neighbour give (u, m(u)) through the node's own minimum
        out = out.union(least.filter("m < u").select("u", F.col("m").alias("v")))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        out = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u > v").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (u, v: long), root being the
    component's smallest node.  Null ends and self-links are no links; repeated
    and reversed links count once; an empty table gives an empty result.

    Alternates large-star and small-star steps until the links are stars; each
    round is written to the shared folder, and the driver sees two numbers of
    it."""
    links = (links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links, last = stage(links, "links"), None
    while True:
        links = stage(_star(_star(links, True), False), "links")
        seen = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if seen == last:
            break
        last = seen
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
