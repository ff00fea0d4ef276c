"""COCO-style AP vs a plain-Python restatement of the greedy protocol on the smallest fixture."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from boxframe.operators import metrics as M
from boxframe.operators.boxes import drop_invalid
from boxframe.operators.coco import coco_winners, top_detections
from boxframe.operators.components import label_components
from tests.test_geometry import py_iou


def _box(r):
    return (r["xmin"], r["ymin"], r["xmax"], r["ymax"])


def py_coco_ap(g, d, thr, max_dets):
    by = defaultdict(list)
    for x in d:
        by[(x["ImageID"], x["LabelName"])].append(x)
    kept = []
    for key, xs in by.items():
        kept += sorted(xs, key=lambda x: (-x["score"], x["det_id"]))[:max_dets]
    gts = defaultdict(list)
    for a in g:
        gts[(a["ImageID"], a["LabelName"])].append(a)
    tp_ids = set()
    for key, xs in defaultdict(list, {k: [x for x in kept if (x["ImageID"], x["LabelName"]) == k] for k in by}).items():
        taken = set()
        for x in sorted(xs, key=lambda x: (-x["score"], x["det_id"])):
            best, m = None, min(thr, 1 - 1e-10)
            for a in sorted(gts[key], key=lambda a: a["box_id"]):
                if a["box_id"] in taken:
                    continue
                v = py_iou(_box(a), _box(x))
                if v <= 0 or v < m:
                    continue
                m, best = v, a["box_id"]
            if best is not None:
                taken.add(best)
                tp_ids.add(x["det_id"])
    out = {}
    for c in {a["LabelName"] for a in g}:
        n = sum(1 for a in g if a["LabelName"] == c)
        dets = sorted((x for x in kept if x["LabelName"] == c), key=lambda x: (-x["score"], x["det_id"]))
        ctp, prec, fs = 0, [], []
        for k, x in enumerate(dets, 1):
            ctp += x["det_id"] in tp_ids
            prec.append(ctp / k)
            fs.append((100 * ctp) // n)
        s = 0.0
        for i in range(101):
            ks = [k for k in range(len(fs)) if fs[k] >= i]
            s += max(prec[ks[0]:]) if ks else 0.0
        out[c] = s / 101
    return out


def test_coco_ap_matches_python(fx):
    gt = drop_invalid(fx.scaled)
    # a few images get many overlapping duplicates so greedy order and the top-k cap matter
    det = fx.detections
    extra = det.where(F.col("det_id") % 3 == 0).select(
        "ImageID", (F.col("det_id") * 10 + 7).alias("det_id"), "LabelName",
        (F.col("score") * 0.9).alias("score"), "xmin", "ymin", "xmax", "ymax")
    det = det.unionByName(extra)
    g = [r.asDict() for r in gt.collect()]
    d = [r.asDict() for r in det.collect()]
    for thr, k in ((0.5, 100), (0.75, 2)):
        got = {r.LabelName: r.ap for r in M.average_precision(gt, det, [thr], matching="coco", max_dets=k).collect()}
        want = py_coco_ap(g, d, thr, k)
        assert got.keys() == want.keys()
        for c in got:
            assert abs(got[c] - want[c]) < 1e-9, (thr, k, c, got[c], want[c])


def test_top_detections_two_stage(spark):
    rows = [("img", i, "a", float(i % 97)) for i in range(5000)] + [("img", 10_000 + i, "b", 1.0) for i in range(3)]
    det = spark.createDataFrame(rows, "ImageID string, det_id long, LabelName string, score double")
    top = top_detections(det, k=10, salt=8).collect()
    a = sorted(((-r.score, r.det_id) for r in top if r.LabelName == "a"))
    want = sorted((-float(i % 97), i) for i in range(5000))[:10]
    assert a == want
    assert sum(r.LabelName == "b" for r in top) == 3


def test_coco_keeps_all_detections_by_default(spark):
    """More than 100 detections of one image and class: the right one is the worst-scored."""
    gt = spark.createDataFrame([("i", 1, "a", 0, 0, 10, 10)], "ImageID string, box_id long, LabelName string, xmin int, ymin int, xmax int, ymax int")
    rows = [("i", k, "a", 1.0 - k / 1000, 500, 500, 510, 510) for k in range(150)] + [("i", 999, "a", 0.01, 0, 0, 10, 10)]
    det = spark.createDataFrame(rows, "ImageID string, det_id long, LabelName string, score double, xmin int, ymin int, xmax int, ymax int")
    assert M.average_precision(gt, det, [0.5], matching="coco").first().ap > 0
    assert M.average_precision(gt, det, [0.5], matching="coco", max_dets=100).first().ap == 0


def test_equal_ids_in_two_images(spark):
    """det_id and box_id are unique within an image only."""
    kind = "ImageID string, {} long, LabelName string, {}xmin int, ymin int, xmax int, ymax int"
    gt = spark.createDataFrame([("i", 1, "a", 0, 0, 10, 10), ("j", 1, "a", 0, 0, 10, 10)], kind.format("box_id", ""))
    det = spark.createDataFrame([("i", 1, "a", 0.9, 0, 0, 10, 10), ("j", 1, "a", 0.8, 50, 50, 60, 60)], kind.format("det_id", "score double, "))
    for matching in ("coco", "voc"):
        assert abs(M.average_precision(gt, det, [0.5], matching=matching).first().ap - 51 / 101) < 1e-9


def _chain(n):
    """Detection k overlaps boxes k and k+1, the latter better; each is rivalled by the one before."""
    gt = [("img", k, "a", 10.0 * k, 0.0, 10.0 * k + 10, 10.0) for k in range(n + 1)]
    det = [("img", k, "a", 1.0 - k / (10 * n), 10.0 * k + 5.2, 0.0, 10.0 * k + 15.2, 10.0) for k in range(n)]
    return gt, det


def _frames(spark, gt, det):
    box = "xmin double, ymin double, xmax double, ymax double"
    return (spark.createDataFrame(gt, f"ImageID string, box_id long, LabelName string, {box}"),
            spark.createDataFrame(det, f"ImageID string, det_id long, LabelName string, score double, {box}"))


def _jobs(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("", "")


def test_a_long_chain_of_rivals_needs_no_more_jobs(spark):
    counts = []
    for n in (6, 200):
        gt, det = _frames(spark, *_chain(n))
        won, jobs = _jobs(spark, f"chain-{n}", lambda: coco_winners(gt, det, [0.2, 0.3], cell=None)[0].count())
        counts.append((won, jobs))
    assert counts[0][1] == counts[1][1]
    assert counts[1][0] == 400


def test_all_ways_of_playing_agree(spark):
    """Groups, components and rounds give the plain greedy result, on crowded images with ties."""
    rng = random.Random(9)
    gt, det = [], []
    for image in ("x", "y"):
        for k in range(120):
            x, y = rng.randrange(60), rng.randrange(12)
            gt.append((image, k, "ab"[k % 2], float(x), float(y), x + 8.0, y + 8.0))
            x, y = rng.randrange(60), rng.randrange(12)
            det.append((image, k, "ab"[rng.randrange(2)], rng.randrange(6) / 6, float(x), float(y), x + 8.0, y + 8.0))
    for k in range(40):  # many small components in one class
        gt.append(("x", 1000 + k, "c", 20.0 * k, 0.0, 20.0 * k + 10, 10.0))
        det.append(("x", 1000 + k, "c", 0.5, 20.0 * k + 1, 0.0, 20.0 * k + 10, 10.0))
    g, d = _frames(spark, gt, det)
    thresholds = [0.5, 0.2, 1.0, 0.35]
    want = set()
    for t in thresholds:
        for image in ("x", "y"):
            for label in "abc":
                taken = set()
                mine = [x for x in det if x[0] == image and x[2] == label]
                for x in sorted(mine, key=lambda x: (-x[3], x[1])):
                    best = max(((py_iou(b[3:], x[4:]), b[1]) for b in gt if b[0] == image and b[2] == label and b[1] not in taken), default=(0, 0))
                    if best[0] >= min(t, 1 - 1e-10):
                        taken.add(best[1])
                        want.add((t, image, x[1]))
    assert len(want) > 100
    for bound in (200_000, 50, 3):
        won = [tuple(r) for r in coco_winners(g, d, thresholds, cell=None, group_pairs=bound)[0].collect()]
        assert len(won) == len(set(won)) and set(won) == want, bound


def test_groups_over_several_arrow_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        gt, det = _frames(spark, *_chain(60))
        assert coco_winners(gt, det, [0.2], cell=None)[0].count() == 60
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (102, 101), (7, 7), (200, 200)]
    got = {r.node: r.root for r in label_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, 101: 100, 102: 100}
    assert label_components(spark.createDataFrame([], "a long, b long")).collect() == []
