"""Placement of rows on shards by a permutation-filled lookup table.

Every shard orders the slots of a prime-sized table by a permutation of its own
(``offset + k * skip``, both taken from a hash of its name) and the shards take
turns claiming the first free slot of their order until the table is full; a
shard of weight w claims w slots a turn. The table has a fixed size (a
parameter, not the data's), so it is broadcast, and a row's shard is one lookup
of ``hash(key) mod size``. Adding or removing a shard moves few other rows.

Defined cases: a null key is replaced by the row's other key columns, or, when
all are null, by ``fallback`` columns, so that rows without an id spread over
the shards; equal keys (repeated rows) always share a shard; other columns pass
through, and a clashing ``slot`` or ``shard`` column is replaced; a key is
hashed whole, however long; no ties arise, as a slot has one shard; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A prime; the broadcast table has as many rows.
TABLE_SIZE = 65_537


def _prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def build_table(shards: Sequence[str], size: int = TABLE_SIZE, weights: Sequence[int] | None = None) -> list[int]:
    """The shard (its place in ``shards``) of every slot."""
    weights = list(weights or [1] * len(shards))
    if not shards or len(set(shards)) != len(shards) or len(weights) != len(shards):
        raise ValueError("shards must be distinct names, with one weight each")
    if min(weights) < 0 or not any(weights):
        raise ValueError("weights are not negative, and one is above 0")
    if not _prime(size) or size < sum(weights):
        raise ValueError("the table size must be a prime of at least the sum of the weights")
    offset = [_hash(f"offset:{s}") % size for s in shards]
    skip = [_hash(f"skip:{s}") % (size - 1) + 1 for s in shards]
    table, step, free = [-1] * size, [0] * len(shards), size
    while free:
        for s, turns in enumerate(weights):
            for _ in range(min(turns, free)):
                slot = (offset[s] + step[s] * skip[s]) % size
                while table[slot] >= 0:
                    step[s] += 1
                    slot = (offset[s] + step[s] * skip[s]) % size
                table[slot] = s
                step[s] += 1
                free -= 1
    return table


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE,
                weights: Sequence[int] | None = None) -> DataFrame:
    """The lookup table as ``(slot, shard)`` rows: one row per slot."""
    slots = T.StructType([T.StructField("slot", T.LongType(), False), T.StructField("shard", T.StringType(), False)])
    return spark.createDataFrame([(i, shards[s]) for i, s in enumerate(build_table(shards, size, weights))], slots)


def slot_of(keys: Sequence[str], size: int = TABLE_SIZE, fallback: Sequence[str] = ()) -> Column:
    """Slot of a row: 60 bits of a hash of its keys, modulo the table size."""
    key = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys])
    if fallback:
        rest = F.concat_ws("\x1f", *[F.col(c).cast("string") for c in fallback])
        key = F.when(F.coalesce(*[F.col(k).cast("string") for k in keys]).isNull(), rest).otherwise(key)
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long"), F.lit(size))


def assign_shards(docs: DataFrame, table: DataFrame, keys: Sequence[str] = ("doc_id",),
                  size: int = TABLE_SIZE, fallback: Sequence[str] = ()) -> DataFrame:
    """``docs`` with the columns ``slot`` and ``shard``; no row is shuffled."""
    taken = [c for c in ("slot", "shard") if c in docs.columns and c not in (*keys, *fallback)]
    placed = docs.drop(*taken).withColumn("slot", slot_of(keys, size, fallback))
    return placed.join(F.broadcast(table), "slot", "left")


def moved_share(old: Sequence[int], new: Sequence[int]) -> float:
    """Share of the slots whose shard differs between two tables."""
    return sum(a != b for a, b in zip(old, new, strict=True)) / len(old)
