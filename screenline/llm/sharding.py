"""Sharding by a lookup table that the shards fill in turns.

Every shard has its own permutation of the slots of a table of prime size,
given by an offset and a step. The shards take turns, each claiming the first
slot of its permutation that is still free, until the table is full; so shards
own equal numbers of slots (give or take one), and taking a shard away moves
few slots besides its own. A row is placed by one hash and one lookup in the
table, which is broadcast: its size is a parameter and has nothing to do with
the number of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenline.session import local_table

SHARDS = 64
SLOTS = 65_537
# A table of more slots is refused: it would be too large to broadcast.
MOST_SLOTS = 5_000_011


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(text: str) -> int:
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """The position in ``shards`` of the owner of each slot."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shard names must be distinct, at least one and at most one per slot")
    if not is_prime(slots) or slots > MOST_SLOTS:
        raise ValueError(f"the number of slots must be a prime up to {MOST_SLOTS}")
    place = [_number("offset:" + s) % slots for s in shards]
    step = [_number("step:" + s) % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % slots
            owner[place[i]] = i
            free -= 1
            if not free:
                break
    return np.array(owner, np.int32)


def table_frame(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    owner = lookup_table(shards, slots)
    return local_table(spark, [(i, shards[o]) for i, o in enumerate(owner)], "slot long, shard string")


def slot_of(keys: list[Column], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("long")


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def place(df: DataFrame, keys: list[str], shards: list[str] | None = None, slots: int = SLOTS) -> DataFrame:
    """``df`` with two columns more, slot and shard, by hash of ``keys``.

    Equal keys go to one shard, null keys too: they hash like any other value.
    Columns of ``df`` named slot or shard are replaced. An empty table gives an
    empty one. Rows are not moved.
    """
    shards = shard_names() if shards is None else shards
    table = F.broadcast(table_frame(df.sparkSession, shards, slots))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), slot_of([F.col(f"`{k}`") for k in keys], slots).alias("slot"))
    kept = [F.col(f"row.`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    return rows.join(table, "slot").select(*kept, "slot", "shard")


def write_shards(placed: DataFrame, path: str, files: int = 1) -> None:
    """One folder per shard, its rows spread over ``files`` files."""
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.lit(files))
    placed.repartition("shard", part).write.mode("overwrite").partitionBy("shard").parquet(path)
