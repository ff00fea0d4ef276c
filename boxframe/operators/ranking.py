"""Exact row numbers over large inputs without a single-partition window.

``rank_by_hash`` numbers rows by a uniformly distributed hex key (an md5 of a
unique id): counts per key prefix give each prefix its offset, and the row
number inside a prefix is a window over about ``ROWS_PER_PREFIX`` rows. The
offsets are summed in two levels (four hex digits, then the rest), so that no
task sums more than 65,536 cells of a group at once. ``global_row_number`` orders by arbitrary columns: small
inputs use one window, large ones range partitions plus partition offsets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxframe.session import cut_lineage

ROWS_PER_PREFIX = 2_000  # target rows per (group, key prefix) cell
COARSE_HEX = 4  # hex digits of the offsets' first level


def prefix_length(n_rows: int, n_groups: int = 1, rows_per_prefix: int = ROWS_PER_PREFIX) -> int:
    """Hex digits of key prefix so that each (group, prefix) cell holds about ``rows_per_prefix`` rows.

    Keeps the offsets table near ``n_rows / rows_per_prefix`` rows whatever
    the number of groups, and the window inside a cell small.
    """
    cells = max(1.0, n_rows / max(1, n_groups) / rows_per_prefix)
    return int(min(8, max(1, math.ceil(math.log(cells, 16)))))


def rank_by_hash(
    df: DataFrame,
    order_key: str,
    tiebreak: str,
    partition_cols: list[str] | None = None,
    out: str = "rn",
    prefix_hex: int | None = None,
    with_total: str | None = None,
    n_groups: int = 1,
) -> DataFrame:
    """1-based row number per ``partition_cols`` ordered by ``(order_key, tiebreak)``.

    ``order_key`` must be a lower-case hex string whose prefix is uniform
    (md5); ``with_total`` adds the partition's row count under that name.
    Without ``prefix_hex`` the prefix length comes from a row count and
    ``n_groups`` (the number of partition groups, e.g. shards x epochs).
    """
    parts = list(partition_cols or [])
    if prefix_hex is None:
        from boxframe.operators.stats import row_count

        prefix_hex = prefix_length(row_count(df), n_groups)
    d = df.withColumn("_pre", F.substring(F.col(order_key), 1, prefix_hex))
    counts = d.groupBy(*parts, "_pre").agg(F.count(F.lit(1)).alias("_c"))

    def before(groups: list[str], order: str):
        w = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_c").over(w), F.lit(0))

    def total(groups: list[str]):
        return [F.sum("_c").over(Window.partitionBy(*groups)).alias(with_total)] if with_total else []

    if prefix_hex <= COARSE_HEX:
        offs = counts.select(*parts, "_pre", before(parts, "_pre").alias("_off"), *total(parts))
    else:
        counts = counts.withColumn("_top", F.substring("_pre", 1, COARSE_HEX))
        tops = counts.groupBy(*parts, "_top").agg(F.sum("_c").alias("_c"))
        tops = tops.select(*parts, "_top", before(parts, "_top").alias("_base"), *total(parts))
        within = counts.select(*parts, "_top", "_pre", before([*parts, "_top"], "_pre").alias("_in"))
        offs = within.join(tops, [*parts, "_top"]).select(
            *parts, "_pre", (F.col("_base") + F.col("_in")).alias("_off"), *([with_total] if with_total else []))
    j = d.join(offs, [*parts, "_pre"])
    w = Window.partitionBy(*parts, "_pre").orderBy(order_key, tiebreak)
    return j.withColumn(out, F.row_number().over(w) + F.col("_off")).drop("_pre", "_off")


def global_row_number(
    df: DataFrame,
    order_cols: list[Column | str],
    out: str = "rn",
    single_task_limit: int = 2_000_000,
    num_partitions: int | None = None,
) -> DataFrame:
    """1-based row number over a total order given by ``order_cols``.

    Counts first. Up to ``single_task_limit`` rows one window task is used
    (a bounded input such as a label set); beyond it the rows are range
    partitioned, numbered per partition and shifted by the sizes of the
    partitions before (a table with one row per partition).
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    from boxframe.operators.stats import row_count

    n = row_count(df)
    if n <= single_task_limit:
        return df.withColumn(out, F.row_number().over(Window.orderBy(*cols)))
    parts = num_partitions or max(1, n // 1_000_000)
    r = df.repartitionByRange(parts, *cols).withColumn("_pid", F.spark_partition_id())
    # Materialised once so both branches see the same partition ids.
    r = cut_lineage(r.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid").orderBy(*cols))))
    sizes = r.groupBy("_pid").agg(F.count(F.lit(1)).alias("_c"))
    offs = sizes.select(
        "_pid", F.coalesce(F.sum("_c").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off")
    )
    return r.join(F.broadcast(offs), "_pid").withColumn(out, F.col("_lrn") + F.col("_off")).drop("_pid", "_lrn", "_off")
