"""Connected components of a table of links, by repeated stars.

Every node points to the smallest node it has met. A round joins each node's
smallest neighbour to all its larger neighbours, then to its smaller ones; the
links left at the end point from every node straight to the smallest node of
its component. Only minima are gathered per node, never lists of neighbours, so
a node with very many links is an ordinary aggregate and a splittable join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenline.session import cut


def _round(links: DataFrame, large: bool) -> DataFrame:
    """links: u > v. One star operation; gives links u > v again."""
    if large:
        both = links.select("u", "v").unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = links
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    low = least.select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    met = both.join(low, F.col("u") == F.col("_u")).select("u", "v", "m")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            low.select(F.col("_u").alias("u"), F.col("m").alias("v"))
        )
    out = out.where("u > v")
    return out if large else out.distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for each node that has a
    link to another one. Nulls and links of a node to itself are left out; an
    empty table gives an empty one. Each round is written to the shared folder,
    so a lost executor costs one round at most; the number of rounds grows with
    the logarithm of the longest path."""
    now = cut(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    )
    seen = None
    while True:
        state = now.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        if not state["n"] or state == seen:
            break
        seen = state
        now = cut(_round(_round(now, True), False))
    low = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    return low.unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
