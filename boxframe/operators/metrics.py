"""Detection metrics as DataFrame queries (no per-image Python).

Inputs are long form: truth boxes ``gt`` (``ImageID, box_id, LabelName, xmin..ymax``)
and detections ``det`` (``ImageID, det_id, LabelName, score, xmin..ymax``).
Every grouping here is a partial+final aggregate or a window over a bounded
group; pairs come from the grid join in ``pairs.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxframe.operators.pairs import overlap_pairs
from boxframe.operators.scan import prefix_sum
from boxframe.session import cut_lineage

IOU_THRESHOLDS = [round(0.5 + 0.05 * i, 2) for i in range(10)]  # 0.50:0.05:0.95
NONE_LABEL = "__none__"


def _ratio(num, den):
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def _f1(p, r):
    return F.when((p + r) > 0, F.lit(2) * (p * r) / (p + r)).otherwise(F.lit(0.0))


def iou_pairs(gt: DataFrame, det: DataFrame, same_label: bool = False, **kw) -> DataFrame:
    """Truth/prediction pairs of an image with positive overlap and their IoU."""
    return overlap_pairs(gt, det, same="LabelName" if same_label else None, **kw)


def best_iou(gt: DataFrame, pairs: DataFrame) -> DataFrame:
    """Best IoU of each truth box over the image's predictions, 0 without any."""
    # every truth box enters with IoU 0, so a box without any prediction keeps 0; one aggregation, no join
    u = gt.select("ImageID", "box_id", F.lit(0.0).alias("iou")).unionByName(pairs.select("ImageID", "box_id", "iou"))
    return u.groupBy("ImageID", "box_id").agg(F.max("iou").alias("best_iou"))


def match_one_to_one(pairs: DataFrame, threshold: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """Each prediction takes its best truth (IoU > threshold; ties: lowest box_id),
    each truth keeps its best such prediction (ties: lowest det_id).

    Two aggregations of ``max(struct)``, which combine map-side, instead of
    windows that would sort a heavily shared box in one task. Grouping keys
    include ``ImageID`` (functionally dependent) so it is carried along, and
    so are the pair columns named in ``carry`` (e.g. both labels).
    """
    p = pairs.where(F.col("iou") > threshold)
    per_det = p.groupBy("ImageID", "det_id").agg(
        F.max(F.struct("iou", (-F.col("box_id")).alias("nb"), *carry)).alias("m")
    )
    per_det = per_det.select("ImageID", "det_id", F.col("m.iou").alias("iou"), (-F.col("m.nb")).alias("box_id"),
                             *[F.col(f"m.{c}").alias(c) for c in carry])
    per_gt = per_det.groupBy("ImageID", "box_id").agg(
        F.max(F.struct("iou", (-F.col("det_id")).alias("nd"), *carry)).alias("m")
    )
    return per_gt.select("ImageID", "box_id", (-F.col("m.nd")).alias("det_id"), F.col("m.iou").alias("iou"),
                         *[F.col(f"m.{c}").alias(c) for c in carry])


def detection_counts(gt: DataFrame, det: DataFrame, pairs: DataFrame, threshold: float = 0.5,
                     mode: str = "per_image", single_task_rows: int | None = None) -> DataFrame:
    """Per image ``n_gt, n_pred, tp, fp, fn``.

    ``per_image``: tp = truth boxes whose best IoU > threshold.
    ``cumulative``: tp counted over all images up to this one (ordered by
    ImageID), while fp/fn use this image's sizes -- the original evaluation
    loop's behaviour; fp and fn can go negative.
    ``one_to_one``: tp = truth boxes matched one-to-one.
    Predictions' labels and scores are ignored, as in that loop. The true
    positives come from the pair table alone (it carries ImageID).
    """
    if mode == "one_to_one":
        hits = match_one_to_one(pairs, threshold).select("ImageID", F.lit(1).alias("_t"))
    elif mode in ("per_image", "cumulative"):
        best = pairs.groupBy("ImageID", "box_id").agg(F.max("iou").alias("_b"))
        hits = best.select("ImageID", (F.col("_b") > threshold).cast("int").alias("_t"))
    else:
        raise ValueError(mode)
    # one aggregation over truth, predictions and hits instead of three plus two joins
    zero, one = F.lit(0), F.lit(1)
    u = (
        gt.select("ImageID", one.alias("_g"), zero.alias("_d"), zero.alias("_t"))
        .unionByName(det.select("ImageID", zero.alias("_g"), one.alias("_d"), zero.alias("_t")))
        .unionByName(hits.select("ImageID", zero.alias("_g"), zero.alias("_d"), "_t"))
    )
    c = u.groupBy("ImageID").agg(
        F.sum("_g").cast("bigint").alias("n_gt"), F.sum("_d").cast("bigint").alias("n_pred"),
        F.sum("_t").cast("bigint").alias("tp"),
    ).where(F.col("n_gt") > 0)  # images with truth are the evaluated images
    if mode == "cumulative":
        kw = {} if single_task_rows is None else {"single_task_rows": single_task_rows, "num_partitions": 7}
        c = prefix_sum(c, ["ImageID"], "tp", "tp", **kw)
    return c.select(
        "ImageID", "n_gt", "n_pred", "tp",
        (F.col("n_pred") - F.col("tp")).alias("fp"), (F.col("n_gt") - F.col("tp")).alias("fn"),
    )


def prf_per_image(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per image with zero guards."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    p = _ratio(tp, tp + fp)
    r = _ratio(tp, tp + fn)
    return counts.select("ImageID", p.alias("precision"), r.alias("recall")).withColumn(
        "f1", _f1(F.col("precision"), F.col("recall"))
    )


def macro_summary(best: DataFrame, prf: DataFrame) -> DataFrame:
    """Mean IoU over truth boxes and mean P/R/F1 over images (NULL on empty input).

    One aggregation over the union of box rows and image rows: ``avg`` and
    ``count`` skip the NULLs of the other side, so no join is needed.
    """
    nd = F.lit(None).cast("double")
    u = best.select(F.col("best_iou").alias("_iou"), nd.alias("_p"), nd.alias("_r"), nd.alias("_f")).unionByName(
        prf.select(nd.alias("_iou"), F.col("precision").alias("_p"), F.col("recall").alias("_r"), F.col("f1").alias("_f"))
    )
    return u.agg(
        F.round(F.avg("_iou"), 6).alias("mean_iou"), F.round(F.avg("_p"), 6).alias("mean_precision"),
        F.round(F.avg("_r"), 6).alias("mean_recall"), F.round(F.avg("_f"), 6).alias("mean_f1"),
        F.count("_iou").alias("n_boxes"), F.count("_p").alias("n_images"),
    )


def label_pairs(gt: DataFrame, det: DataFrame, matches: DataFrame) -> DataFrame:
    """``(y_true, y_pred)`` per matched pair; unmatched truth pairs with ``__none__``,
    unmatched predictions the other way round."""
    m = matches.select("ImageID", "box_id", "det_id")
    t = gt.select("ImageID", "box_id", F.col("LabelName").alias("y_true"))
    dl = det.select("ImageID", "det_id", F.col("LabelName").alias("y_pred"))
    # unmatched rows never enter the pair join, so no NULL key gathers them
    matched = m.join(t, ["ImageID", "box_id"]).join(dl, ["ImageID", "det_id"]).select("y_true", "y_pred")
    truth_left = t.join(m, ["ImageID", "box_id"], "left_anti").select("y_true", F.lit(NONE_LABEL).alias("y_pred"))
    pred_left = dl.join(m, ["ImageID", "det_id"], "left_anti").select(F.lit(NONE_LABEL).alias("y_true"), "y_pred")
    return matched.unionByName(truth_left).unionByName(pred_left)


def weighted_prf(pairs_labels: DataFrame) -> DataFrame:
    """Support-weighted precision/recall/F1 over classes (``__none__`` has no weight), zero_division=0."""
    zero, one = F.lit(0), F.lit(1)
    u = pairs_labels.select(
        F.col("y_true").alias("c"), one.alias("_s"), zero.alias("_p"),
        (F.col("y_true") == F.col("y_pred")).cast("int").alias("_h"),
    ).unionByName(pairs_labels.select(F.col("y_pred").alias("c"), zero.alias("_s"), one.alias("_p"), zero.alias("_h")))
    return _weighted(u)


def weighted_prf_matched(gt: DataFrame, det: DataFrame, matches: DataFrame) -> DataFrame:
    """``weighted_prf`` without building the label-pair table.

    Every truth box is a ``y_true`` exactly once and every prediction a
    ``y_pred`` exactly once, so support and predicted counts come straight
    from ``gt`` and ``det``; only the hits need the matches' labels. With
    ``y_true``/``y_pred`` carried in ``matches`` (see ``labelled_matches``)
    all three counts are one aggregation; otherwise the labels are joined.
    """
    if {"y_true", "y_pred"} <= set(matches.columns):
        hits = matches.where(F.col("y_true") == F.col("y_pred")).select(F.col("y_true").alias("c"))
    else:
        g = gt.select("ImageID", "box_id", F.col("LabelName").alias("_t"))
        d = det.select("ImageID", "det_id", F.col("LabelName").alias("_p"))
        hits = (
            matches.select("ImageID", "box_id", "det_id").join(g, ["ImageID", "box_id"]).join(d, ["ImageID", "det_id"])
            .where(F.col("_t") == F.col("_p")).select(F.col("_t").alias("c"))
        )
    zero, one = F.lit(0), F.lit(1)
    u = (
        gt.select(F.col("LabelName").alias("c"), one.alias("_s"), zero.alias("_p"), zero.alias("_h"))
        .unionByName(det.select(F.col("LabelName").alias("c"), zero.alias("_s"), one.alias("_p"), zero.alias("_h")))
        .unionByName(hits.select("c", zero.alias("_s"), zero.alias("_p"), one.alias("_h")))
    )
    return _weighted(u)


def _weighted(u: DataFrame) -> DataFrame:
    """``u``: rows ``c, _s, _p, _h`` (support, predicted, hit indicators) -> weighted P/R/F1.

    Per-class counts are one aggregation; the weighted means a second one
    over the (bounded) class rows.
    """
    per = u.groupBy("c").agg(
        F.sum("_s").alias("support"), F.sum("_p").alias("n_pred"), F.sum("_h").alias("tp")
    ).where((F.col("support") > 0) & (F.col("c") != NONE_LABEL))
    p = _ratio(F.col("tp"), F.col("n_pred"))
    r = _ratio(F.col("tp"), F.col("support"))
    per = per.select("c", "support", p.alias("p"), r.alias("r")).withColumn("f", _f1(F.col("p"), F.col("r")))
    tot = F.sum("support").cast("double")
    return per.agg(
        F.round(F.sum(F.col("support") * F.col("p")) / tot, 6).alias("precision"),
        F.round(F.sum(F.col("support") * F.col("r")) / tot, 6).alias("recall"),
        F.round(F.sum(F.col("support") * F.col("f")) / tot, 6).alias("f1"),
    )


def labelled_matches(gt: DataFrame, det: DataFrame, threshold: float = 0.5, **kw) -> DataFrame:
    """One-to-one matches (label-agnostic) carrying ``y_true`` and ``y_pred``."""
    if isinstance(kw.get("cell", "auto"), str):
        # decide the join strategy on the original frames (memoised), not the renamed ones
        from boxframe.operators.pairs import auto_cell

        kw["cell"] = auto_cell(gt, det)
    pairs = overlap_pairs(
        gt.withColumnRenamed("LabelName", "y_true"), det.withColumnRenamed("LabelName", "y_pred"),
        gt_cols=("y_true",), det_cols=("y_pred",), **kw,
    )
    return match_one_to_one(pairs, threshold, carry=("y_true", "y_pred"))


def voc_true_positives(gt: DataFrame, det: DataFrame, thresholds: list[float], cell="auto") -> DataFrame:
    """Per detection and IoU threshold: ``det_id, LabelName, score, iou_thr, tp``.

    A detection takes its best-IoU truth of the same class (ties: lowest
    box_id); it is a true positive at threshold t when that IoU exceeds t and
    it has the highest score (ties: lowest det_id) among the detections
    claiming the same truth box at t. The winners (at most one per truth box
    and threshold) are collected per detection before the thresholds are
    expanded, so the join sees one row per detection.
    """
    won = voc_winners(gt, det, thresholds, cell).groupBy("ImageID", "det_id").agg(F.collect_list("iou_thr").alias("_won"))
    thr = F.array(*[F.lit(float(t)) for t in thresholds])
    d = det.select("ImageID", "det_id", "LabelName", "score").join(won, ["ImageID", "det_id"], "left")
    d = d.select("det_id", "LabelName", "score", F.coalesce("_won", F.array().cast("array<double>")).alias("_won"),
                 F.explode(thr).alias("iou_thr"))
    return d.select("det_id", "LabelName", "score", "iou_thr",
                    F.array_contains("_won", F.col("iou_thr")).cast("int").alias("tp"))


def voc_winners(gt: DataFrame, det: DataFrame, thresholds: list[float], cell="auto") -> DataFrame:
    """``iou_thr, ImageID, det_id``: the true positives at each threshold (VOC matching, see ``voc_true_positives``)."""
    pairs = overlap_pairs(gt, det, same="LabelName", det_cols=("score",), cell=cell)
    best = pairs.groupBy("ImageID", "det_id").agg(
        F.max(F.struct("iou", (-F.col("box_id")).alias("nb"))).alias("m"), F.max("score").alias("score")
    )
    cand = best.select(
        "ImageID", "score", F.col("m.iou").alias("iou"), (-F.col("m.nb")).alias("box_id"), (-F.col("det_id")).alias("nd")
    ).where(F.col("iou") > float(min(thresholds)))
    # all thresholds of a box in one row: candidates are not repeated for each of them
    bests = [F.max(F.when(F.col("iou") > float(t), F.struct("score", "nd"))).alias(f"_w{i}") for i, t in enumerate(thresholds)]
    winners = cand.groupBy("ImageID", "box_id").agg(*bests)
    each = F.array(*[F.struct(F.lit(float(t)).alias("iou_thr"), F.col(f"_w{i}").alias("w")) for i, t in enumerate(thresholds)])
    return winners.select("ImageID", F.inline(each)).where("w is not null").select("iou_thr", "ImageID", (-F.col("w.nd")).alias("det_id"))


def average_precision(gt: DataFrame, det: DataFrame, thresholds: list[float] | None = None,
                      cell="auto", single_task_rows: int | None = None, matching: str = "voc",
                      max_dets: int | None = None) -> DataFrame:
    """101-point interpolated AP per ``(LabelName, iou_thr)`` for every class with truth.

    Detections of a class are ranked by score (ties: det_id). The rank ``k``
    does not depend on the threshold, so it is computed once per detection;
    per threshold only the true positives are needed: the running count
    ``ctp`` over them in rank order gives each one's precision ``ctp / k``.
    The counts of all thresholds run along one row per true positive, so nothing
    that is sorted or shuffled is repeated for each threshold.
    Recall point i/100 is reached from the first rank where
    ``f = floor(100*ctp/n)`` >= i, and its interpolated precision is the max
    precision over ranks with a larger-or-equal ``f``; that maximum is always
    attained at a true positive (precision only falls between them). So the
    ranks collapse to at most 101 ``(f, max precision)`` steps per class,
    the envelope is a suffix max over those steps, and
    ``AP = sum_j S_j * (f_j - f_{j-1}) / 101`` with ``f_0 = -1``.
    Both ordered passes use ``segmented_prefix`` (a window per class, or
    range partitions when a class is too large for one task). A class with
    truth and no true positive scores 0.

    ``matching="coco"`` uses greedy per-image matching (``coco.py``) instead,
    over all detections, or the top ``max_dets`` of each image and class.
    """
    from boxframe.operators.scan import SINGLE_TASK_ROWS, segmented_prefix
    from boxframe.operators.stats import largest_group

    thresholds = thresholds or IOU_THRESHOLDS
    limit = single_task_rows if single_task_rows is not None else SINGLE_TASK_ROWS
    if matching == "coco":
        from boxframe.operators.coco import coco_winners

        winners, det = coco_winners(gt, det, thresholds, max_dets, cell)
    elif matching == "voc":
        winners = voc_winners(gt, det, thresholds, cell)
    else:
        raise ValueError(matching)
    n_gt = gt.groupBy("LabelName").agg(F.count(F.lit(1)).alias("n_gt"))
    largest = largest_group(det, ["LabelName"])
    ranks = segmented_prefix(
        det.select("ImageID", "det_id", "LabelName", "score"), ["LabelName"],
        [F.col("score").desc(), F.col("det_id"), F.col("ImageID")],
        {"k": F.lit(1)}, max_segment_rows=largest, single_task_rows=limit,
    )
    # one row per detection that wins at any threshold; each threshold has a running count of its own
    won = winners.groupBy("ImageID", "det_id").agg(F.collect_set("iou_thr").alias("_won"))
    tp = won.join(ranks.select("ImageID", "det_id", "LabelName", "k"), ["ImageID", "det_id"])
    if largest > limit:  # range partitions count and sample their input first: the matching runs once for all three
        tp = cut_lineage(tp, "ap-hits")
    single = list(dict.fromkeys(float(t) for t in thresholds))
    tp = segmented_prefix(tp, ["LabelName"], [F.col("k")], {f"_c{i}": F.array_contains("_won", t).cast("int") for i, t in enumerate(single)},
                          max_segment_rows=largest, single_task_rows=limit)
    counts = F.array(*[F.struct(F.lit(t).alias("iou_thr"), F.col(f"_c{i}").alias("ctp")) for i, t in enumerate(single)])
    tp = tp.select("LabelName", "k", F.inline(F.filter(counts, lambda c: F.array_contains("_won", c["iou_thr"]))))
    seg = ["LabelName", "iou_thr"]
    steps = tp.join(n_gt, "LabelName").groupBy(*seg, F.expr("(100 * ctp) div n_gt").alias("f")).agg(
        F.max(F.col("ctp").cast("double") / F.col("k").cast("double")).alias("m")
    )
    w_suffix = Window.partitionBy(*seg).orderBy(F.col("f").desc()).rowsBetween(Window.unboundedPreceding, 0)
    w_prev = Window.partitionBy(*seg).orderBy("f")
    steps = steps.select(*seg, "f", F.max("m").over(w_suffix).alias("env"),
                         F.coalesce(F.lag("f").over(w_prev), F.lit(-1)).alias("fprev"))
    ap = steps.groupBy(*seg).agg((F.sum(F.col("env") * (F.col("f") - F.col("fprev"))) / F.lit(101.0)).alias("ap"))
    grid = n_gt.select("LabelName", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])).alias("iou_thr"))
    return grid.join(ap, seg, "left").select("LabelName", "iou_thr", F.coalesce("ap", F.lit(0.0)).alias("ap"))


def mean_average_precision(ap: DataFrame) -> DataFrame:
    """Mean AP over classes with truth and over thresholds."""
    return ap.agg(F.round(F.avg("ap"), 6).alias("map"))


def loss_by_epoch(log: DataFrame) -> DataFrame:
    """Summed loss and batch count per ``(rank, epoch)`` of a training log."""
    return log.groupBy("rank", "epoch").agg(
        F.round(F.sum("loss"), 6).alias("epoch_loss"), F.count(F.lit(1)).alias("n_batches")
    )
