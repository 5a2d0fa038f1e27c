"""Connected components of a table of links, by stars: each round hangs every
node's larger neighbours, then its smaller ones, on its least neighbour. When a
round changes nothing, every node hangs on the least node of its component."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenline.session import cut, fits

# Ship the helpers with the job: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Links that one task takes.
FEW = 100_000


def _joined(links: pd.DataFrame) -> pd.DataFrame:
    """Union by least node."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = above[y]
            x = above[x]
        return x

    for high, low in zip(links["high"].tolist(), links["low"].tolist()):
        a, b = top(high), top(low)
        above[max(a, b)] = min(a, b)
    return pd.DataFrame({"node": list(above), "component": [top(x) for x in list(above)]}, dtype="int64")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first())


def components(links: DataFrame, few: int = FEW) -> DataFrame:
    """(node, component) of every node of the links (columns a and b, long);
    the component is its least node. Links of a node with itself, repeated ones
    and both directions are allowed; nulls are left out. A table of at most
    ``few`` distinct links is worked through in one task."""
    given = links.where("a is not null and b is not null")
    held = cut(given.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct())
    if fits(held, few):
        return held.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(_joined, "node long, component long")
    nodes = held.select(F.explode(F.array("high", "low")).alias("node")).distinct()
    held = held.where("high <> low")
    before = _state(held)
    while before[0]:
        both = held.unionByName(held.select(F.col("high").alias("low"), F.col("low").alias("high")))
        # high: the node, low: its neighbour.
        least = both.groupBy("high").agg(F.least(F.min("low"), F.first("high")).alias("least"))
        larger = both.join(least, "high").where(F.col("low") > F.col("high")).select(F.col("low").alias("high"), F.col("least").alias("low")).distinct()
        root = larger.groupBy("high").agg(F.min("low").alias("least"))
        moved = larger.join(root, "high").where(F.col("low") != F.col("least")).select(F.col("low").alias("high"), F.col("least").alias("low"))
        held = cut(moved.unionByName(root.select("high", F.col("least").alias("low"))).distinct())
        now = _state(held)
        if now == before:
            break
        before = now
    return nodes.join(held.withColumnRenamed("high", "node"), "node", "left").select("node", F.coalesce("low", "node").alias("component"))
