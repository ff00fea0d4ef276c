"""Running sums over a total order without funnelling all rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.session import cut_lineage

# Up to this many rows a running sum is one window task.
SINGLE_TASK_ROWS = 2_000_000


def prefix_sum(
    df: DataFrame,
    order_cols: list[str],
    value_col: str,
    out: str,
    single_task_rows: int = SINGLE_TASK_ROWS,
    num_partitions: int | None = None,
) -> DataFrame:
    """``out`` = sum of ``value_col`` over all rows up to this one in ``order_cols`` order.

    Small inputs use one window. Large ones are range partitioned on the
    order; each partition computes its local running sum, and the totals of
    the partitions before it (one row per partition, broadcast) are added.
    ``order_cols`` must be unique per row for a well-defined result.
    """
    from boxframe.operators.stats import row_count

    n = row_count(df)
    if n <= single_task_rows:
        w = Window.orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, F.sum(value_col).over(w))
    parts = num_partitions or max(2, n // 1_000_000)
    r = df.repartitionByRange(parts, *order_cols).withColumn("_pid", F.spark_partition_id())
    w_local = Window.partitionBy("_pid").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    # Materialised once: both branches below must see the same partition ids
    # (a re-sampled range partitioner could draw other bounds).
    r = cut_lineage(r.withColumn("_local", F.sum(value_col).over(w_local)))
    tot = r.groupBy("_pid").agg(F.sum(value_col).alias("_t"))
    offs = tot.select(
        "_pid",
        F.coalesce(F.sum("_t").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    return r.join(F.broadcast(offs), "_pid").withColumn(out, F.col("_local") + F.col("_off")).drop("_pid", "_local", "_off")


def segmented_prefix(
    df: DataFrame,
    seg_cols: list[str],
    order_cols: list,
    sums: dict,
    max_segment_rows: int | None = None,
    single_task_rows: int = SINGLE_TASK_ROWS,
    rows_per_partition: int = 1_000_000,
) -> DataFrame:
    """Running sums inside each segment, ordered by ``order_cols`` (Columns or names).

    ``sums`` maps output name -> value Column. When the largest segment is at
    most ``single_task_rows`` (``max_segment_rows``, counted here if not
    given) one window per segment is used. Otherwise a segment may span many
    range partitions: each partition sums locally and adds the totals of the
    same segment in the partitions before it, so a hot segment is spread over
    many tasks. Ties in ``order_cols`` must not occur (add a unique id).
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    if max_segment_rows is None:
        max_segment_rows = df.groupBy(*seg_cols).count().agg(F.max("count")).first()[0] or 0
    vals = {k: (v if not isinstance(v, str) else F.col(v)) for k, v in sums.items()}
    if max_segment_rows <= single_task_rows:
        w = Window.partitionBy(*seg_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        out = df
        for k, v in vals.items():
            out = out.withColumn(k, F.sum(v).over(w))
        return out
    n = df.count()
    parts = max(2, n // rows_per_partition)
    r = df.repartitionByRange(parts, *[F.col(c) for c in seg_cols], *order).withColumn("_pid", F.spark_partition_id())
    for k, v in vals.items():
        r = r.withColumn(f"_v_{k}", v)
    w_local = Window.partitionBy("_pid", *seg_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    for k in vals:
        r = r.withColumn(f"_l_{k}", F.sum(f"_v_{k}").over(w_local))
    r = cut_lineage(r)  # one set of partition ids for both branches
    tot = r.groupBy("_pid", *seg_cols).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in vals])
    w_before = Window.partitionBy(*seg_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("_pid", *seg_cols, *[F.coalesce(F.sum(f"_t_{k}").over(w_before), F.lit(0)).alias(f"_o_{k}") for k in vals])
    if offs.count() <= 1_000_000:  # one row per (partition, segment) piece
        offs = F.broadcast(offs)
    j = r.join(offs, ["_pid", *seg_cols])
    for k in vals:
        j = j.withColumn(k, F.col(f"_l_{k}") + F.col(f"_o_{k}"))
    drop = ["_pid"] + [f"_{p}_{k}" for k in vals for p in ("v", "l", "o")]
    return j.drop(*drop)
