"""COCO-style matching for AP: per image and class, detections in score order
greedily take the best still-free truth box with IoU >= threshold.

Detections compete only along chains of shared truth boxes, so the greedy step
falls apart into groups that can be played one by one:

* An (image, class) of at most ``GROUP_PAIRS`` pairs is one group.
* Larger ones are cut into connected components of rivalry (detections and
  truth boxes joined by the pairs at the lowest threshold; a higher threshold
  only takes pairs away, so one labelling serves all of them).
* Groups are dealt over the cluster, sorted by score, and one pass over each
  partition plays every group to its end, all thresholds at once. A task holds
  one group and one Arrow batch.
* A component that is itself over the bound is played in rounds: a detection
  whose best free truth box has no better-scored undecided suitor takes it,
  exactly as it would in score order. Rounds are aggregations and joins, each
  written, so a lost executor costs one round.

``max_dets`` keeps the best-scored detections of each image and class, as the
public protocol does with 100; the default keeps all. Selecting them is a
two-stage top-k, so an image with a huge number of detections is never ranked
in a single task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.operators.components import label_components
from boxframe.operators.pairs import overlap_pairs
from boxframe.session import cut_lineage, cut_lineage_counted, ship_package

SALT = 64
#: Pairs of an (image, class) or component that are played in one task.
GROUP_PAIRS = 200_000
_GROUP = ["ImageID", "LabelName", "_part"]


def top_detections(det: DataFrame, k: int, by: tuple[str, ...] = ("ImageID", "LabelName"), salt: int = SALT) -> DataFrame:
    """The ``k`` highest-scoring detections (ties: det_id) of every ``by`` group.

    Stage one keeps the top ``k`` of each (group, salt) slice, stage two the
    top ``k`` of the at most ``k * salt`` survivors; both windows are bounded.
    """
    order = [F.col("score").desc(), F.col("det_id")]
    s = det.withColumn("_salt", F.pmod(F.xxhash64("det_id"), F.lit(salt)))
    s = s.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_salt").orderBy(*order))).where(F.col("_r") <= k)
    s = s.withColumn("_r", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_r") <= k)
    return s.drop("_salt", "_r")


def floor_of(threshold: float) -> float:
    """The least IoU that a threshold accepts: the protocol never asks for more than 1 - 1e-10."""
    return min(float(threshold), 1 - 1e-10)


def play_group(det: list[int], box: list[int], iou: list[float], floors: list[float]) -> list[tuple[int, int]]:
    """``(row, threshold number)`` of the wins of one group.

    Rows are pairs, those of a detection together, best-scored detections
    first. ``floors`` are the thresholds' least IoUs, ascending.
    """
    won, taken = [], [set() for _ in floors]
    i, n = 0, len(det)
    while i < n:
        j = i + 1
        while j < n and det[j] == det[i]:
            j += 1
        rows = sorted(range(i, j), key=lambda r: (iou[r], box[r]), reverse=True)
        for t, least in enumerate(floors):
            if iou[rows[0]] < least:
                break
            for r in rows:
                if iou[r] < least:
                    break
                if box[r] not in taken[t]:
                    taken[t].add(box[r])
                    won.append((r, t))
                    break
        i = j
    return won


def _play(thresholds: list[float]):
    order = sorted(range(len(thresholds)), key=lambda k: floor_of(thresholds[k]))
    floors = [floor_of(thresholds[k]) for k in order]

    def wins(table: pa.Table) -> pa.RecordBatch:
        """All wins of the groups of a table, whose groups are whole and in order."""
        det, box, iou = (table.column(c).to_numpy() for c in ("det_id", "box_id", "iou"))
        start = np.flatnonzero(table.column("_first").to_numpy())
        size = np.diff(np.append(start, len(det)))
        rows, which = [], []
        # a pair without rivals wins at every threshold that it reaches
        alone = start[size == 1]
        for t, least in enumerate(floors):
            hit = alone[iou[alone] >= least]
            rows.append(hit), which.append(np.full(len(hit), t))
        for a, k in zip(start[size > 1].tolist(), size[size > 1].tolist()):
            got = play_group(det[a : a + k].tolist(), box[a : a + k].tolist(), iou[a : a + k].tolist(), floors)
            rows.append(np.array([a + r for r, _ in got], np.int64)), which.append(np.array([t for _, t in got], np.int64))
        at, t = np.concatenate(rows), np.concatenate(which).astype(np.int64)
        values = np.array([thresholds[k] for k in order], np.float64)
        image = table.column("ImageID").combine_chunks().take(pa.array(at, pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(values[t]), image, pa.array(det[at], pa.int64())], names=["iou_thr", "ImageID", "det_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the open group's rows so far
        for batch in batches:
            first = np.flatnonzero(batch.column(batch.schema.get_field_index("_first")).to_numpy(zero_copy_only=False))
            if not len(first) or (not held and len(first) == 1):
                held.append(batch)
                continue
            cut = int(first[-1])
            if held or cut:
                yield wins(pa.Table.from_batches([*held, *([batch.slice(0, cut)] if cut else [])]))
            held = [batch.slice(cut)]
        if held:
            yield wins(pa.Table.from_batches(held))

    return run


def play_groups(pairs: DataFrame, thresholds: list[float]) -> DataFrame:
    """``iou_thr, ImageID, det_id`` won in the groups (ImageID, LabelName, _part) of ``pairs``, one pass per partition."""
    ship_package(pairs.sparkSession)
    order = [F.col(c) for c in _GROUP] + [F.col("score").desc(), F.col("det_id")]
    # A row opens a group if the row before it, in this very order, is of another one.
    before = Window.partitionBy(*_GROUP).orderBy(F.col("score").desc(), F.col("det_id"), "box_id")
    marked = pairs.withColumn("_first", (F.row_number().over(before) == 1).cast("int")).sortWithinPartitions(*order, "box_id")
    return marked.select("ImageID", "det_id", "box_id", "iou", "_first").mapInArrow(
        _play(thresholds), "iou_thr double, ImageID string, det_id bigint")


def play_rounds(pairs: DataFrame, thresholds: list[float]) -> DataFrame:
    """The same by rounds over all of ``pairs``, for components that no task should hold."""
    thr = F.array(*[F.lit(float(t)) for t in thresholds])
    left, n_left = cut_lineage_counted(
        pairs.select("ImageID", "det_id", "box_id", "score", "iou", F.explode(thr).alias("iou_thr")).where(
            F.col("iou") >= F.least("iou_thr", F.lit(1 - 1e-10))), "coco-pairs")
    by_det, by_box = ["iou_thr", "ImageID", "det_id"], ["iou_thr", "ImageID", "box_id"]
    rounds: list[DataFrame] = []
    while n_left:
        best = left.groupBy(*by_det).agg(F.max(F.struct("iou", "box_id")).alias("m")).select(*by_det, F.col("m.box_id").alias("box_id"))
        first = left.groupBy(*by_box).agg(F.max(F.struct("score", (-F.col("det_id")).alias("nd"))).alias("m")).select(
            *by_box, (-F.col("m.nd")).alias("det_id"))
        won = cut_lineage(best.join(first, [*by_det, "box_id"]), "coco-round")
        rounds.append(won)
        left, n_left = cut_lineage_counted(
            left.join(won.select(*by_det), by_det, "left_anti").join(won.select(*by_box), by_box, "left_anti"), "coco-pairs")
    return reduce(DataFrame.unionByName, rounds).select(*by_det) if rounds else left.select(*by_det)


def _by_component(pairs: DataFrame) -> DataFrame:
    """``pairs`` with ``_part``: the number of the pair's component (a hash of its smallest member) within image and class."""
    node = [F.struct("ImageID", "LabelName", F.lit(side).alias("side"), F.col(c).cast("bigint").alias("id"))
            for side, c in ((0, "det_id"), (1, "box_id"))]
    roots = label_components(pairs.select(node[0].alias("a"), node[1].alias("b")))
    named = roots.select("node.ImageID", "node.LabelName", F.col("node.side").alias("_side"), F.col("node.id").alias("det_id"),
                         F.xxhash64("root.side", "root.id").alias("_part"))
    # the smallest node of a component is a detection (side 0), which is a root without a row of its own
    mine = pairs.join(named.where("_side = 0").drop("_side"), ["ImageID", "LabelName", "det_id"], "left")
    return mine.withColumn("_part", F.coalesce("_part", F.xxhash64(F.lit(0), F.col("det_id").cast("bigint"))))


def coco_winners(gt: DataFrame, det: DataFrame, thresholds: list[float], max_dets: int | None = None,
                 cell="auto", group_pairs: int = GROUP_PAIRS) -> tuple[DataFrame, DataFrame]:
    """``(winners, kept)``: true positives ``iou_thr, ImageID, det_id`` and the detections taking part.

    Ties: equal scores go by det_id (the smaller first), equal IoUs to the
    larger box_id, as a later box replaces an earlier one in the protocol.
    """
    kept = det if max_dets is None else top_detections(det, max_dets)
    pairs = overlap_pairs(gt, kept, same="LabelName", det_cols=("score", "LabelName"), cell=cell)
    pairs = pairs.where(F.col("iou") >= min(floor_of(t) for t in thresholds))
    pairs = cut_lineage(pairs.select("ImageID", "LabelName", F.col("det_id").cast("bigint").alias("det_id"),
                                     F.col("box_id").cast("bigint").alias("box_id"), "score", "iou"), "coco-pairs")
    sizes = pairs.groupBy("ImageID", "LabelName").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > group_pairs)
    large, n_large = cut_lineage_counted(sizes.select("ImageID", "LabelName"), "coco-large")
    whole = F.lit(0).cast("bigint").alias("_part")
    if not n_large:
        return play_groups(pairs.select("*", whole), thresholds), kept
    key = ["ImageID", "LabelName"]
    small = pairs.join(large, key, "left_anti").select("*", whole)
    parts = cut_lineage(_by_component(pairs.join(large, key, "left_semi")), "coco-parts")
    giants, n_giants = cut_lineage_counted(parts.groupBy(*_GROUP).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > group_pairs).drop("_n"), "coco-giants")
    rest = parts.join(giants, _GROUP, "left_anti").select(small.columns)
    won = play_groups(small.unionByName(rest), thresholds)
    if n_giants:
        won = won.unionByName(play_rounds(parts.join(giants, _GROUP, "left_semi"), thresholds))
    return won, kept
