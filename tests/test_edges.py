"""Edge cases from the test strategy: empty inputs, NULL ids, ties, unmatched images."""

from pyspark.sql import functions as F

from boxframe.operators import metrics as M
from boxframe.operators.presence import listing_ids, missing_images, with_existing_images

GT = "ImageID string, box_id long, LabelName string, xmin int, ymin int, xmax int, ymax int"
DET = "ImageID string, det_id long, LabelName string, score double, xmin int, ymin int, xmax int, ymax int"


def test_empty_listing_and_null_ids(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "ImageID string")
    empty = listing_ids(spark.createDataFrame([], "path string"))
    assert with_existing_images(df, empty).count() == 0
    assert sorted(r.ImageID or "-" for r in missing_images(df, empty).collect()) == ["-", "a", "b"]
    ids = listing_ids(spark.createDataFrame([("gs://x/a.jpg",), ("gs://x/b.png",)], "path string"))
    assert [r.ImageID for r in with_existing_images(df, ids).collect()] == ["a"]  # NULL id never matches


def test_zero_images(spark):
    gt = spark.createDataFrame([], GT)
    det = spark.createDataFrame([], DET)
    pairs = M.iou_pairs(gt, det)
    assert M.detection_counts(gt, det, pairs).count() == 0
    m = M.macro_summary(M.best_iou(gt, pairs), M.prf_per_image(M.detection_counts(gt, det, pairs))).first()
    assert m.mean_iou is None and m.n_boxes == 0 and m.n_images == 0
    assert M.average_precision(gt, det).count() == 0
    assert M.mean_average_precision(M.average_precision(gt, det)).first().map is None


def test_prediction_without_truth_and_image_without_prediction(spark):
    gt = spark.createDataFrame([("i1", 1, "a", 0, 0, 10, 10), ("i2", 2, "a", 0, 0, 10, 10)], GT)
    det = spark.createDataFrame([("i1", 5, "a", 0.9, 0, 0, 10, 10), ("i3", 6, "a", 0.95, 0, 0, 10, 10)], DET)
    pairs = M.iou_pairs(gt, det)
    c = {r.ImageID: (r.n_gt, r.n_pred, r.tp, r.fp, r.fn) for r in M.detection_counts(gt, det, pairs).collect()}
    assert c == {"i1": (1, 1, 1, 0, 0), "i2": (1, 0, 0, 0, 1)}  # i3 has no truth: not an evaluated image
    p = {r.ImageID: (r.precision, r.recall, r.f1) for r in M.prf_per_image(M.detection_counts(gt, det, pairs)).collect()}
    assert p["i2"] == (0.0, 0.0, 0.0)
    # AP: the unmatched prediction (i3) ranks first, so precision at the single TP is 1/2
    ap = M.average_precision(gt, det, [0.5]).first().ap
    assert abs(ap - (51 * 0.5) / 101) < 1e-12


def test_score_and_iou_ties_are_deterministic(spark):
    gt = spark.createDataFrame([("i", 1, "a", 0, 0, 10, 10), ("i", 2, "a", 0, 0, 10, 10)], GT)
    # two identical detections with the same score: the lower det_id claims first
    det = spark.createDataFrame([("i", 8, "a", 0.5, 0, 0, 10, 10), ("i", 7, "a", 0.5, 0, 0, 10, 10)], DET)
    w = M.voc_winners(gt, det, [0.5]).collect()
    assert [(r.iou_thr, r.det_id) for r in w] == [(0.5, 7)]  # both take truth 1 (lowest box_id); det 7 wins the tie
    m = sorted((r.box_id, r.det_id) for r in M.match_one_to_one(M.iou_pairs(gt, det)).collect())
    assert m == [(1, 7)]
    coco = M.average_precision(gt, det, [0.5], matching="coco").first().ap
    assert coco == 1.0  # greedy: det 7 takes a free box, det 8 the other one
