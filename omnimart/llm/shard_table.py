"""Placement of keys on shards through a permutation-filled lookup table.

The table has a prime number of slots. Every shard has its own order of all slots (an offset and
a step, both from digests of its name), and shards take turns claiming their next free slot, so each
gets an equal share to within one slot. If a shard is added or removed, few slots change
hands between the others. A key's slot is its hash modulo the table size, and the table, of
fixed size, is broadcast: placing a row costs one lookup and no shuffle, whatever the number of
rows or the weight of a key.

The main path is DataFrame code; the table itself, a parameter like the shard names, is
filled on the driver. A null key is a key like any other; an empty table gives an empty result;
repeated keys share a shard. Extra columns pass through, a clash with a result
column is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

SLOTS = 65_537


def _digest(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Shard index of each slot."""
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("between one shard and one a slot, all of different names")
    if slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime")
    # Turns go round in the order of names, so the table does not depend on the order given.
    turns = sorted(range(len(shards)), key=lambda i: shards[i])
    place = [_digest(s, "offset") % slots for s in shards]
    step = [_digest(s, "step") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while True:
        for i in turns:
            at = place[i]
            while owner[at] >= 0:
                at = (at + step[i]) % slots
            owner[at] = i
            place[i] = (at + step[i]) % slots
            free -= 1
            if not free:
                return owner


def lookup(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The table as rows (slot, shard)."""
    owners = F.split(F.lit(",".join(map(str, fill(shards, slots)))), ",")
    names = F.split(F.lit("\n".join(shards)), "\n")
    return spark.range(slots).select(F.col("id").alias("slot"), F.element_at(names, F.element_at(owners, (F.col("id") + 1).cast("int")).cast("int") + 1).alias("shard"))


def place(rows: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with slot and shard of the column ``key``."""
    if {"slot", "shard"} & set(rows.columns):
        raise ValueError("the input has a column slot or shard")
    hashed = F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(slots))
    return rows.withColumn("slot", hashed).join(F.broadcast(lookup(rows.sparkSession, shards, slots)), "slot").select(*(F.col(f"`{c}`") for c in rows.columns), "slot", "shard")
