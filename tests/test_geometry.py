"""Box arithmetic vs plain-Python restatements and properties."""

import random

from pyspark.sql import functions as F

from boxframe.functions.geometry import caption, clamp_box, iou, to_pixel


def py_iou(a, b):
    x1, y1 = max(a[0], b[0]), max(a[1], b[1])
    x2, y2 = min(a[2], b[2]), min(a[3], b[3])
    inter = max(0, x2 - x1) * max(0, y2 - y1)
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - inter
    return inter / union if union > 0 else 0


def test_iou_matches_python_and_properties(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(400):
        a = [rnd.randint(-20, 320) for _ in range(4)]
        b = [rnd.randint(-20, 320) for _ in range(4)]
        if rnd.random() < 0.3:
            b = list(a)
        rows.append((*a, *b))
    df = spark.createDataFrame(rows, "a0 int, a1 int, a2 int, a3 int, b0 int, b1 int, b2 int, b3 int")
    A, Bx = ("a0", "a1", "a2", "a3"), ("b0", "b1", "b2", "b3")
    got = df.select(iou(A, Bx).alias("ab"), iou(Bx, A).alias("ba")).collect()
    for r, g in zip(rows, got):
        want = py_iou(r[:4], r[4:])
        assert g.ab == want and g.ba == want
        assert 0.0 <= g.ab <= 1.0 or py_iou(r[:4], r[4:]) == g.ab
        if r[:4] == r[4:] and (r[2] - r[0]) * (r[3] - r[1]) > 0 and r[2] > r[0]:
            assert g.ab == 1.0


def test_scaling_keeps_operand_order_and_clamps(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([1.0, 0.0, 0.5, rnd.uniform(-0.2, 1.2)]), rnd.randint(1, 1999)) for _ in range(2000)]
    rows += [(1.0, 275), (1.0, 550), (None, 10)]
    df = spark.createDataFrame(rows, "x double, w int")
    px = to_pixel("x", F.col("w"), 299)
    lo, _, hi, _ = clamp_box(px, px, px, px, 299, 299)
    got = df.select(px.alias("p"), lo.alias("lo"), hi.alias("hi")).collect()
    for (x, w), g in zip(rows, got):
        if x is None:
            assert g.p is None and g.lo is None and g.hi is None
            continue
        want = int(x * w * (299 / w))
        assert g.p == want
        assert g.lo == max(0, want) and g.hi == min(299, want)
    assert [g.p for g in got[-3:-1]] == [298, 298]  # 1.0 * w * (299 / w) falls just below 299


def test_caption_rounds_like_python(spark):
    vals = [k / 1000 for k in range(0, 1001)] + [0.145, 0.125, 12345.675]
    df = spark.createDataFrame([(3, v) for v in vals], "l int, s double")
    got = [r.c for r in df.select(caption("l", "s").alias("c")).collect()]
    assert got == [f"{3} ({v:.2f})" for v in vals]


def test_non_finite_coordinates_quarantine_the_image(spark):
    from boxframe.operators.boxes import scale_boxes

    boxes = spark.createDataFrame(
        [("a", 1, 0.1, 0.1, 0.5, 0.5, "x"), ("a", 2, 0.1, 0.1, float("inf"), 0.5, "x"),
         ("b", 3, float("nan"), 0.1, 0.5, 0.5, "x"), ("c", 4, 0.1, 0.1, 0.5, 0.5, "x")],
        "ImageID string, box_id long, XMin double, YMin double, XMax double, YMax double, LabelName string",
    )
    meta = spark.createDataFrame([("a", 100, 100), ("b", 100, 100), ("c", 100, 100)], "ImageID string, width int, height int")
    r = scale_boxes(boxes, meta)
    assert {x.ImageID for x in r.result.collect()} == {"c"}
    assert {x.ImageID for x in r.quarantine.collect()} == {"a", "b"}


def test_huge_coordinates_are_clamped(spark):
    df = spark.createDataFrame([(1e300,), (-1e300,), (float("nan"),), (None,)], "x double")
    px = to_pixel("x", F.lit(100), 299)
    lo, _, hi, _ = clamp_box(px, px, px, px, 299, 299)
    got = [tuple(r) for r in df.select(lo, hi).collect()]
    assert got == [(2**31 - 1, 299), (0, -(2**31)), (None, None), (None, None)]


def test_scaling_flags_no_image_without_a_bad_box(spark):
    """Only images with a bad coordinate are collected; the others are not counted up box by box."""
    from boxframe.operators.boxes import scale_boxes

    boxes = spark.createDataFrame([("a", 0.1, 0.1, 0.5, 0.5), ("a", 0.2, 0.2, 0.3, 0.4), ("b", 0.1, None, 0.5, 0.5), ("b", 0.1, 0.1, 0.5, 0.5),
                                   ("c", 0.1, 0.1, 0.5, 0.5), (None, 0.1, 0.1, 0.5, 0.5), ("d", 0.1, 0.1, 0.5, 0.5), ("e", 0.1, 0.1, 0.5, 0.5)],
                                  "ImageID string, XMin double, YMin double, XMax double, YMax double")
    meta = spark.createDataFrame([("a", 100, 100, None), ("a", 200, 200, None), ("b", 100, 100, None), ("d", 0, 100, None), ("e", 9, 9, "no"), ("e", None, 9, None),
                                  (None, 5, 5, None)], "ImageID string, width int, height int, error string")
    r = scale_boxes(boxes, meta)
    assert sorted(x.ImageID for x in r.result.collect()) == ["a"] * 4
    assert {(x.ImageID, x.error) for x in r.quarantine.collect()} == {
        ("b", "null or NaN coordinate"), ("c", "image not found"), (None, "image not found"), ("d", "bad image size"), ("e", "no"), ("e", "bad image size")}
    plan = r.result._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and "max(" not in plan
