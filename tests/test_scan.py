"""The range-partitioned paths of the ordering helpers equal the single-window paths."""

from pyspark.sql import functions as F

from boxframe.operators import metrics as M
from boxframe.operators.boxes import drop_invalid
from boxframe.operators.ranking import global_row_number, rank_by_hash
from boxframe.operators.scan import prefix_sum, segmented_prefix


def test_prefix_sum_paths_agree(spark):
    df = spark.range(0, 5000).select(F.format_string("k%05d", "id").alias("k"), (F.col("id") % 7).alias("v"))
    a = {r.k: r.s for r in prefix_sum(df, ["k"], "v", "s").collect()}
    b = {r.k: r.s for r in prefix_sum(df, ["k"], "v", "s", single_task_rows=0, num_partitions=7).collect()}
    assert a == b
    assert a["k04999"] == sum(i % 7 for i in range(5000))


def test_global_row_number_paths_agree(spark):
    df = spark.range(0, 3000).select(F.md5(F.col("id").cast("string")).alias("h"))
    a = {r.h: r.rn for r in global_row_number(df, ["h"]).collect()}
    b = {r.h: r.rn for r in global_row_number(df, ["h"], single_task_limit=0, num_partitions=5).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(1, 3001))
    assert [h for h, _ in sorted(a.items(), key=lambda x: x[1])] == sorted(a)


def test_rank_by_hash_is_exact(spark):
    df = spark.range(0, 4000).select(F.col("id"), F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 3).alias("p"))
    got = rank_by_hash(df, "h", "id", partition_cols=["p"], out="rn", prefix_hex=2, with_total="n").collect()
    for p in range(3):
        rows = sorted((r for r in got if r.p == p), key=lambda r: r.h)
        assert [r.rn for r in rows] == list(range(1, len(rows) + 1))
        assert all(r.n == len(rows) for r in rows)


def test_segmented_prefix_paths_agree(spark):
    df = spark.range(0, 6000).select(
        (F.col("id") % 3).alias("seg"), F.col("id"), ((F.col("id") * 37) % 101).alias("score"), (F.col("id") % 2).alias("v")
    )
    order = [F.col("score").desc(), F.col("id")]
    sums = {"k": F.lit(1), "c": F.col("v")}
    a = {(r.id): (r.k, r.c) for r in segmented_prefix(df, ["seg"], order, sums).collect()}
    b = {(r.id): (r.k, r.c) for r in segmented_prefix(df, ["seg"], order, sums, single_task_rows=0, rows_per_partition=500).collect()}
    assert a == b


def test_average_precision_distributed_path(fx):
    gt = drop_invalid(fx.scaled)
    a = {(r.LabelName, r.iou_thr): r.ap for r in M.average_precision(gt, fx.detections, [0.5, 0.75]).collect()}
    b = {(r.LabelName, r.iou_thr): r.ap
         for r in M.average_precision(gt, fx.detections, [0.5, 0.75], single_task_rows=0).collect()}
    assert a.keys() == b.keys()
    assert all(abs(a[k] - b[k]) < 1e-12 for k in a)
