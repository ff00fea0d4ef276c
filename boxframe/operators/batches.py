"""Shards and batches for data-parallel training, planned in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.functions.hashing import hash_int32, hash_order_key
from boxframe.operators.paging import rows_page  # noqa: F401 - pages belong to the batch interface
from boxframe.operators.ranking import rank_by_hash


def shard_of(key: str, world_size: int, seed: int | None = None):
    """Stable shard in ``[0, world_size)`` from the hash of ``key``."""
    return F.pmod(hash_int32(hash_order_key(key, seed)), F.lit(world_size)).cast("int")


def shard_filter(df: DataFrame, key: str, world_size: int, rank: int, seed: int | None = None) -> DataFrame:
    """Rows of one worker: ``shard(key) == rank``."""
    return df.where(shard_of(key, world_size, seed) == F.lit(rank))


def plan_batches(
    df: DataFrame,
    key: str = "ImageID",
    world_size: int = 1,
    batch_size: int = 8,
    seed: int | None = None,
    drop_last: bool = False,
    partition_cols: list[str] | None = None,
    order_seed_col: str | None = None,
    group_count: int = 1,
    pad: bool = False,
    equal: bool = False,
) -> DataFrame:
    """Add ``shard, batch_no, pos``: disjoint, complete batches of at most ``batch_size``.

    Shards come from the key's hash; inside a shard rows are ordered by
    md5 of the key (optionally salted by ``order_seed_col``, e.g. the epoch),
    numbered exactly with ``rank_by_hash``. ``drop_last`` removes each shard's
    last incomplete batch; with ``equal`` every shard also keeps no more
    batches than the shortest one has, as data-parallel workers that wait for
    each other need. ``pad`` makes every shard of ``0 .. world_size - 1`` as
    long as the longest one by repeating its own first rows (flag ``padded``),
    like a sampler that pads to equal shard lengths; a shard without rows
    repeats those of the longest shard. No row is dropped by ``pad``.
    """
    parts = list(partition_cols or [])
    base = F.col(key).cast("string")
    if order_seed_col:
        base = F.concat(F.col(order_seed_col).cast("string"), F.lit(":"), base)
    okey = hash_order_key(base, seed)
    d = df.withColumn("shard", shard_of(key, world_size)).withColumn("_ok", okey)
    ranked = rank_by_hash(d, "_ok", key, partition_cols=[*parts, "shard"], out="_rn", with_total="_n",
                          n_groups=world_size * group_count)
    if pad:
        ranked = _pad_shards(ranked, parts, world_size)
    out = ranked.withColumn("batch_no", F.floor((F.col("_rn") - 1) / batch_size).cast("int")).withColumn(
        "pos", F.pmod(F.col("_rn") - 1, F.lit(batch_size)).cast("int")
    )
    if drop_last:
        out = out.where(F.col("batch_no") < F.floor(F.col("_n") / batch_size))
    if equal:
        # a group's shards that have no rows at all leave nothing to the others
        sizes = ranked.groupBy(*parts, "shard").agg(F.max("_n").alias("_s"))
        group = Window.partitionBy(*parts)  # one row per shard
        least = F.min("_s").over(group) / batch_size
        least = F.when(F.count(F.lit(1)).over(group) < world_size, 0).otherwise(F.floor(least) if drop_last else F.ceil(least))
        sizes = sizes.select(*parts, "shard", least.alias("_least"))
        out = out.join(sizes, [*parts, "shard"]).where(F.col("batch_no") < F.col("_least")).drop("_least")
    return out.drop("_ok", "_rn", "_n")


def _pad_shards(ranked: DataFrame, parts: list[str], world_size: int) -> DataFrame:
    """Append copies of each shard's first rows until it is as long as the longest shard of its group.

    A shard without rows gets copies of the longest shard's (of equals the
    first). Needs per-shard sizes (one row per group and shard, broadcast). Copy k of
    row rn gets row number ``size * k + rn``; rows get ``padded`` and the
    shard size ``_n`` becomes the padded length.
    """
    sizes = ranked.groupBy(*parts, "shard").agg(F.max("_n").alias("_size"))
    if parts:
        target = sizes.groupBy(*parts).agg(F.max("_size").alias("_target"))
        need = sizes.join(target, parts)
    else:
        need = sizes.withColumn("_target", F.max("_size").over(Window.partitionBy()))
    need = need.select(*parts, "shard", "_size", "_target", (F.col("_target") - F.col("_size")).alias("_need"))
    need = F.broadcast(need)  # one row per (group, shard)
    base = ranked.join(need.select(*parts, "shard", "_target"), [*parts, "shard"]).withColumn("padded", F.lit(False))
    cand = ranked.join(need.where(F.col("_need") > 0), [*parts, "shard"])
    cand = cand.withColumn("_k", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_need") / F.col("_size")).cast("int"))))
    extra = (
        cand.where(F.col("_size") * (F.col("_k") - 1) + F.col("_rn") <= F.col("_need"))
        .withColumn("_rn", F.col("_size") * F.col("_k") + F.col("_rn"))
        .withColumn("padded", F.lit(True))
        .drop("_k", "_size", "_need")
    )
    # shards that no row fell into: one donor shard per group, copied to each of them
    longest = sizes.groupBy(*parts).agg(
        F.max(F.struct("_size", (-F.col("shard")).alias("_s"))).alias("_m"), F.collect_set("shard").alias("_have"))
    missing = longest.select(
        *parts, (-F.col("_m._s")).alias("shard"), F.col("_m._size").alias("_target"),
        F.explode(F.array_except(F.sequence(F.lit(0), F.lit(world_size - 1)), "_have")).alias("_empty"))
    donated = ranked.join(missing, [*parts, "shard"]).withColumn("shard", F.col("_empty")).withColumn("padded", F.lit(True)).drop("_empty")
    both = base.unionByName(extra).unionByName(donated.select(base.columns))
    return both.withColumn("_n", F.col("_target")).drop("_target")


def batch_counts(df: DataFrame, key: str = "ImageID", world_size: int = 1, batch_size: int = 8) -> DataFrame:
    """Rows and batches per shard, and the original loader's ``num_batches``:
    ``ceil((count // world_size) / batch_size)`` from the total row count."""
    per = df.groupBy(shard_of(key, world_size).alias("shard")).agg(F.count(F.lit(1)).alias("n_rows"))
    return per.select(
        "shard", "n_rows",
        F.ceil(F.col("n_rows") / F.lit(batch_size)).cast("bigint").alias("n_batches"),
        # a window over one row per shard
        F.expr(f"((sum(n_rows) over ()) div {world_size} + {batch_size} - 1) div {batch_size}").alias("num_batches"),
    )


def epoch_plan(df: DataFrame, epochs: int, key: str = "ImageID", world_size: int = 1, batch_size: int = 8,
               seed: int = 42, drop_last: bool = False) -> DataFrame:
    """A fresh shuffled batch plan for each epoch ``1..epochs`` (rows repeated by a generator, not a join)."""
    rep = df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    return plan_batches(rep, key, world_size, batch_size, seed=seed, drop_last=drop_last,
                        partition_cols=["epoch"], order_seed_col="epoch", group_count=epochs)


def assemble_batches(plan: DataFrame, item_cols: list[str], group_cols: list[str] | None = None) -> DataFrame:
    """One row per batch with its items in ``pos`` order (a bounded group: ``batch_size`` rows)."""
    g = list(group_cols or ["shard", "batch_no"])
    item = F.struct(F.col("pos"), *[F.col(c) for c in item_cols])
    agg = plan.groupBy(*g).agg(F.array_sort(F.collect_list(item)).alias("items"))
    return agg.select(*g, F.size("items").alias("n_items"), "items")


def partition_by_shard(plan: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Co-locate each shard's rows (``repartition`` on ``shard`` and ``extra``, e.g. epoch).

    Before a ``partitionBy('shard')`` write this gives one file per shard
    folder; shards are hash-balanced, so no partition is hot.
    """
    return plan.repartition(*(extra or []), "shard")
