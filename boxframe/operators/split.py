"""Reproducible splits and samples that do not depend on partitioning."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.functions.hashing import hash_int32, hash_order_key


def split_by_hash(df: DataFrame, key: str = "ImageID", train_fraction: float = 0.8, seed: int = 42,
                  buckets: int = 10000, out: str = "split") -> DataFrame:
    """``train``/``test`` by hash bucket of ``seed:key``: no sort, no shuffle, same rows for any layout."""
    bucket = F.pmod(hash_int32(hash_order_key(key, seed)), F.lit(buckets))
    cut = int(round(train_fraction * buckets))
    return df.withColumn(out, F.when(bucket < cut, F.lit("train")).otherwise(F.lit("test")))


def split_exact(df: DataFrame, key: str = "ImageID", train_fraction: float = 0.8, seed: int = 42,
                out: str = "split") -> DataFrame:
    """Exactly ``floor(train_fraction * n)`` rows to ``train`` in a seeded random order.

    The order is md5(seed:key) (ties: key). Only the position of the K-th
    key matters: a histogram of 4-digit key prefixes (at most 16^4 rows,
    collected; its sum is n) locates the prefix bucket holding it. Rows in earlier buckets are train,
    rows in later buckets are test -- decided map-side, no shuffle of the
    data -- and only the one cut bucket (about n / 65,536 rows) is ranked by a
    window.
    """
    d = df.withColumn("_ok", hash_order_key(key, seed)).withColumn("_pre", F.substring("_ok", 1, 4))
    hist = sorted((r[0], r[1]) for r in d.groupBy("_pre").count().collect())
    n = sum(c for _, c in hist)
    k = int((Decimal(str(train_fraction)) * n).to_integral_value(rounding="ROUND_FLOOR"))
    before, cut, need = 0, None, 0
    for pre, c in hist:
        if before + c >= k:
            cut, need = pre, k - before
            break
        before += c
    train, test = F.lit("train"), F.lit("test")
    if cut is None or k == 0:
        label = train if cut is None and k > 0 else test
        return d.withColumn(out, label).drop("_ok", "_pre")
    outside = d.where(F.col("_pre") != cut).withColumn(out, F.when(F.col("_pre") < cut, train).otherwise(test))
    inside = d.where(F.col("_pre") == cut).withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_pre").orderBy("_ok", key))
    ).withColumn(out, F.when(F.col("_rn") <= need, train).otherwise(test)).drop("_rn")
    return outside.unionByName(inside).drop("_ok", "_pre")


def sample_one(df: DataFrame, key: str = "ImageID", seed: int = 42) -> DataFrame:
    """One seeded random row: a distributed top-1 (per-partition best, then one merge)."""
    return df.orderBy(hash_order_key(key, seed), F.col(key)).limit(1)
