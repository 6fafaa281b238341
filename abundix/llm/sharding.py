"""Sharding with a permutation-filled lookup table.

Every shard has its own order of the table's slots, an arithmetic walk whose start and stride come
from a hash of its name; as the table's size is prime, the walk visits every slot.  Shards take turns
in claiming their next free slot until none is left, which gives each the same number of slots but
for one.  A key belongs to the shard that holds the slot of its hash; when shards come or go, few
other slots change hands.

The table has ``SLOTS`` rows whatever the data, so it is broadcast.

Defined cases: a null key is placed like an empty one; equal keys are placed alike; one shard gets everything;
the placement depends on the key and the shards' names only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SLOTS = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(32))


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's md5."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def slot_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Per slot the index of its shard.  ``slots`` must be prime and not below the number of shards."""
    if not shards or slots < len(shards) or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime and not below the number of shards")
    start = [_hash(f"{name}#start") % slots for name in shards]
    stride = [_hash(f"{name}#stride") % (slots - 1) + 1 for name in shards]
    table, at, free = [-1] * slots, list(start), slots
    while free:
        for i in range(len(shards)):
            if not free:
                break
            while table[at[i]] >= 0:
                at[i] = (at[i] + stride[i]) % slots
            table[at[i]] = i
            free -= 1
    return table


def place(docs: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """``docs`` with the slot of its key and the index of its shard."""
    table = ",".join(map(str, slot_table(shards, slots)))
    lookup = docs.sparkSession.range(slots).select(
        F.col("id").alias("_slot"), F.get(F.split(F.lit(table), ","), F.col("id").cast("int")).cast("int").alias(shard)
    )
    out = docs.withColumn(slot, F.pmod(key_hash(F.col(key)), F.lit(slots).cast("long")))
    return out.join(F.broadcast(lookup), F.col(slot) == F.col("_slot"), "left").drop("_slot")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> None:
    """One folder per shard; the rows of a shard come from many tasks, so none gets a shard whole."""
    place(docs, key, shards, slots, "_place", "shard").drop("_place").write.partitionBy("shard").parquet(path)
