"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a prime-sized
table (offset and skip from its name). Shards take turns claiming their next
free preferred slot until the table is full, so slot counts differ by one at
most, and adding or removing a shard moves few slots. Placement hashes a row's
key to a slot and looks the slot up: constant time, no shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prime, and the proven bound of the broadcast table (rows).
TABLE_SIZE = 65_537


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def fill_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """slot -> index of its shard. Names must be distinct; ``size`` must be prime and no smaller than their number."""
    if not shards:
        raise ValueError("no shards")
    if len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct")
    if not is_prime(size) or size < len(shards):
        raise ValueError(f"the table size must be a prime of at least {len(shards)}")
    at = [_number(s, "offset") % size for s in shards]
    skip = [_number(s, "skip") % (size - 1) + 1 for s in shards] if size > 2 else [1] * len(shards)
    table, left = [-1] * size, size
    while left:
        for k in range(len(shards)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % size
            table[at[k]] = k
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """Slot of a key; NULL keys share the slot of the hash seed."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(size)).cast("int")


def place(docs: DataFrame, shards: Sequence[str], key: str = "doc_id", size: int = TABLE_SIZE,
          slot_col: str = "slot", shard_col: str = "shard") -> DataFrame:
    """``docs`` with the slot and shard of each row, every row kept once.

    Equal keys go to one shard (repeated rows stay together); a NULL key has a
    fixed slot. Other columns pass through; columns named like the two new
    ones are replaced. The broadcast table has exactly ``size`` rows whatever
    the data.
    """
    spark = docs.sparkSession
    table = fill_table(shards, size)
    lookup = spark.createDataFrame([(s, shards[k]) for s, k in enumerate(table)], "slot int, shard string")
    kept = [c for c in docs.columns if c not in (slot_col, shard_col)]
    # own names: none can clash
    keyed = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], slot_of(F.col(f"`{key}`"), size).alias("at"))
    return keyed.join(F.broadcast(lookup), F.col("at") == F.col("slot")).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.col("at").alias(slot_col), F.col("shard").alias(shard_col))


def write_shards(placed: DataFrame, path: str, parts_per_shard: int = 8, shard_col: str = "shard") -> None:
    """One folder per shard, each written by ``parts_per_shard`` tasks; rows are dealt by their hash, so a task that runs again gets the same."""
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns]), F.lit(parts_per_shard)).cast("int")
    placed.withColumn("__part", part).repartition(F.col(shard_col), F.col("__part")).drop("__part").write.partitionBy(
        shard_col).parquet(path)
