"""Partition-independent hash keys for splits, shards and shuffles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_order_key(key: Column | str, seed: int | str | None = None) -> Column:
    """md5 hex of ``seed:key`` (or of ``key``); sorts uniformly at random, same for any partitioning."""
    k = _c(key).cast("string")
    if seed is not None:
        k = F.concat(F.lit(f"{seed}:"), k)
    return F.md5(k)


def hash_int32(order_key: Column | str, start: int = 1) -> Column:
    """Unsigned 32-bit integer from eight hex digits of an md5 key."""
    return F.conv(F.substring(_c(order_key), start, 8), 16, 10).cast("bigint")
