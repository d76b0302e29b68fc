"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a prime-sized table, given by an offset and a step from a hash of
its name. Shards take turns; the one whose turn it is claims its first free slot. All shards end within one slot of
each other, and adding or removing a shard moves little more than its own slots. A row's slot is a hash of its key
modulo the table size; the table has a fixed, checked size, so it is broadcast and placement is one hash lookup.

Defined results: a null key is placed as the empty string; equal keys land on one shard; other columns are kept as they
are (added columns take a free name); an empty table gives an empty frame; no shards, a repeated shard name, a table
that is not prime or has fewer slots than shards is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripecast.llm.common import fresh

SLOTS = 65_537
MOST_SLOTS = 1_000_003


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The shard number of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"{slots} slots: a prime from the number of shards to {MOST_SLOTS} is needed")
    at = [_number(f"offset:{s}") % slots for s in shards]
    step = [_number(f"step:{s}") % (slots - 1) + 1 for s in shards]
    table, free = [-1] * slots, slots
    while free:
        for k in range(len(shards)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + step[k]) % slots
            table[at[k]] = k
            free -= 1
            if not free:
                break
    return table


def lookup(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """slot, shard: the filled table as a frame of ``slots`` rows."""
    rows = [(k, shards[s]) for k, s in enumerate(fill(shards, slots))]
    return spark.createDataFrame(rows, "slot int, shard string")


def place(rows: DataFrame, key: str, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The input rows with slot and shard; no shuffle."""
    slot, shard = fresh(rows.columns, "slot"), fresh(rows.columns, "shard")
    table = lookup(rows.sparkSession, shards, slots).select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    placed = rows.withColumn(slot, (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int"))
    return placed.join(F.broadcast(table), slot, "left").select(*[F.col(f"`{c}`") for c in rows.columns], slot, shard)
