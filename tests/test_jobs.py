"""End-to-end jobs on a temp folder: list -> copy, annotations + images -> processed, training prep, evaluation."""

import os

import numpy as np
from pyspark.sql import functions as F

from boxframe.operators.images import encode_png
from boxframe.plans.jobs import download_job, evaluate_job, long_boxes, prepare_training_job, preprocess_job


def _img(h, w, v):
    a = np.zeros((h, w, 3), np.uint8)
    a[..., 1] = v
    return encode_png(a)


def test_download_job(spark, tmp_path):
    src = tmp_path / "src"
    (src / "train").mkdir(parents=True)
    (src / "test").mkdir(parents=True)
    (src / "train" / "00ab.jpg").write_bytes(b"x" * 10)
    (src / "test" / "00cd.jpg").write_bytes(b"y" * 20)
    lst = tmp_path / "list.txt"
    lst.write_text("train/00ab.jpg\n  test/00cd \ntrain/00ab\nbogus/11\ntrain/ffff\n")
    out = tmp_path / "dst"
    summary = {r.split: (r.n_ok, r.n_total) for r in download_job(
        spark, str(lst), f"{src}/", f"{out}/", str(tmp_path / "manifest")).collect()}
    assert summary == {"train": (1, 2), "test": (1, 1)}  # duplicate copied once; missing id fails
    assert (out / "train" / "00ab.jpg").read_bytes() == b"x" * 10
    assert (out / "test" / "00cd.jpg").stat().st_size == 20
    rejected = [r.line for r in spark.read.parquet(str(tmp_path / "manifest_rejected")).collect()]
    assert rejected == ["bogus/11"]
    # idempotent: a second run copies nothing new and reports the same
    again = {r.split: (r.n_ok, r.n_total) for r in download_job(
        spark, str(lst), f"{src}/", f"{out}/", str(tmp_path / "manifest2")).collect()}
    assert again == summary


def test_preprocess_then_training_then_evaluate(spark, tmp_path):
    imgs = tmp_path / "images"
    imgs.mkdir()
    (imgs / "img1.jpg").write_bytes(_img(100, 200, 10))
    (imgs / "img2.jpg").write_bytes(_img(50, 50, 20))
    (imgs / "img3.jpg").write_bytes(b"corrupt")
    csv = tmp_path / "ann.csv"
    csv.write_text(
        "ImageID,XMin,YMin,XMax,YMax,LabelName\n"
        "img1,0.1,0.2,0.5,0.9,/m/cat\n"
        "img1,-0.1,0.0,1.0,1.2,/m/dog\n"
        "img2,0.2,0.2,0.4,0.4,/m/cat\n"
        "img2,,0.2,0.4,0.4,/m/cat\n"  # null coordinate: whole image to quarantine
        "img3,0.1,0.1,0.2,0.2,/m/cat\n"  # undecodable
        "img4,0.1,0.1,0.2,0.2,/m/dog\n"  # no file
    )
    res = preprocess_job(spark, str(csv), str(imgs), str(tmp_path / "resized") + "/", str(tmp_path / "processed"),
                         str(tmp_path / "quarantine"), ext_in=".jpg")
    p = {r.ImageID: r for r in res.processed.collect()}
    assert set(p) == {"img1"}
    anns = sorted((a.XMin, a.YMin, a.XMax, a.YMax, a.LabelName) for a in p["img1"].Annotations)
    # int(x * w * (299 / w)) with clamps: mins >= 0, maxes <= 299
    assert anns == [(0, 0, 299, 299, "/m/dog"), (29, 59, 149, 269, "/m/cat")]
    assert os.path.exists(str(tmp_path / "resized" / "img1.png"))
    q = {r.ImageID: r.error for r in res.quarantine.collect()}
    assert q == {"img2": "null or NaN coordinate", "img3": "failed to decode image", "img4": "image not found"}

    out = prepare_training_job(spark, str(tmp_path / "processed"), str(tmp_path / "resized"), str(tmp_path / "train"),
                               world_size=2, batch_size=1, epochs=2)
    vocab = {r.LabelName: r.idx for r in out["vocabulary"].collect()}
    assert vocab == {"/m/cat": 0, "/m/dog": 1}
    t = out["targets"].first()
    assert len(t.boxes) == len(t.labels) == 2
    assert out["train_batches"].count() + out["test_batches"].count() in (1, 2)

    truth = long_boxes(res.processed)
    det = truth.select("ImageID", F.col("box_id").alias("det_id"), "LabelName", F.lit(0.9).alias("score"),
                       "xmin", "ymin", "xmax", "ymax")
    ev = evaluate_job(spark, truth, det, str(tmp_path / "eval"))
    assert ev["map"].first().map == 1.0
    m = ev["macro"].first()
    assert (m.mean_iou, m.mean_precision, m.mean_recall, m.mean_f1) == (1.0, 1.0, 1.0, 1.0)
    w = ev["weighted"].first()
    assert (w.precision, w.recall, w.f1) == (1.0, 1.0, 1.0)


def test_cli_download(spark, tmp_path, capsys):
    from boxframe.__main__ import main

    src = tmp_path / "src" / "train"
    src.mkdir(parents=True)
    (src / "00ab.jpg").write_bytes(b"abc")
    lst = tmp_path / "l.txt"
    lst.write_text("train/00ab\n")
    assert main(["download", str(lst), f"{tmp_path}/src/", f"{tmp_path}/dst/", str(tmp_path / "m")], spark) == 0
    assert "train: copied 1 of 1" in capsys.readouterr().out


def test_cli_evaluate(spark, tmp_path, capsys):
    from boxframe.__main__ import main

    truth = spark.createDataFrame(
        [("i1", 1, "/m/a", 10, 10, 50, 50), ("i1", 2, "/m/b", 60, 60, 90, 90), ("i2", 3, "/m/a", 0, 0, 20, 20)],
        "ImageID string, box_id long, LabelName string, xmin int, ymin int, xmax int, ymax int",
    )
    det = spark.createDataFrame(
        [("i1", 10, "/m/a", 0.9, 10, 10, 50, 52), ("i2", 11, "/m/a", 0.8, 100, 100, 120, 120)],
        "ImageID string, det_id long, LabelName string, score double, xmin int, ymin int, xmax int, ymax int",
    )
    truth.write.parquet(str(tmp_path / "t"))
    det.write.parquet(str(tmp_path / "d"))
    assert main(["evaluate", str(tmp_path / "t"), str(tmp_path / "d"), str(tmp_path / "e")], spark) == 0
    out = capsys.readouterr().out
    assert "mAP:" in out and "Precision:" in out and "Average IoU:" in out
    ap = {(r.LabelName, r.iou_thr): r.ap for r in spark.read.parquet(str(tmp_path / "e" / "average_precision")).collect()}
    # class a: one of two truths found at rank 1 (IoU 0.95) -> recall points 0..50 at precision 1
    assert abs(ap[("/m/a", 0.5)] - 51 / 101) < 1e-12
    assert ap[("/m/b", 0.5)] == 0.0


def test_preprocess_keeps_lines_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in ("a", "b", "c"):
        (tmp_path / "in" / f"{k}.png").write_bytes(_img(10, 20, 5))
    csv = tmp_path / "a.csv"
    csv.write_text("ImageID,XMin,YMin,XMax,YMax,LabelName\na,0.1,0.1,0.5,0.5,/m/x\nb,0.1,zero,0.5,0.5,/m/x\nb,0.1,0.1,0.5,0.5,/m/x\nc,0.1\n")
    out = preprocess_job(spark, str(csv), str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "p"), str(tmp_path / "q"), ext_in=".png")
    assert [r.ImageID for r in out.processed.collect()] == ["a"]
    assert {r.ImageID: r.error for r in out.quarantine.collect()} == {"b": "null or NaN coordinate", "c": "null or NaN coordinate"}
    assert {tuple(r) for r in spark.read.parquet(str(tmp_path / "q_lines")).collect()} == {("b", "b,0.1,zero,0.5,0.5,/m/x"), ("c", "c,0.1")}


def test_preprocess_rows_come_in_whole_batches(spark, tmp_path, monkeypatch):
    """batches are small where rows hold pixels, not where they hold paths; images of one batch are worked on one by one."""
    import numpy as np

    from boxframe.operators import images
    from boxframe.operators.images import encode_png
    from boxframe.plans import jobs

    (tmp_path / "in").mkdir()
    for k in range(5):
        (tmp_path / "in" / f"i{k}.png").write_bytes(encode_png(np.full((3, 4, 3), k, np.uint8)))
    csv = tmp_path / "a.csv"
    csv.write_text("ImageID,XMin,YMin,XMax,YMax,LabelName\n" + "".join(f"i{k},0.1,0.1,0.5,0.5,/m/a\n" for k in range(5)))
    name, seen, cut = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, jobs.cut_lineage

    def watch(df, table="table"):
        seen[table] = int(spark.conf.get(name))
        return cut(df, table)

    monkeypatch.setattr(jobs, "cut_lineage", watch)
    before = int(spark.conf.get(name))
    for late in (True, False):
        out = jobs.preprocess_job(spark, str(csv), str(tmp_path / "in"), *[f"{tmp_path}/{late}-{x}" for x in "rpq"], size=(7, 6), ext_in=".png",
                                  decoder=None if late else decode_once)
        assert out.processed.count() == 5 and seen["written"] == before == int(spark.conf.get(name))
    made = []
    monkeypatch.setattr(images, "resize_bilinear", lambda *a: made.append(1) or np.zeros((2, 2, 3), np.uint8))
    write = images._write_rows(str(tmp_path / "one"), ".png", (2, 2), lambda a: bytes(len(made)), None)
    rows = ((f"x{k}", 1, 1, 3, np.zeros((1, 1, 3), np.uint8), None, True) for k in range(3))
    from pyspark import TaskContext

    monkeypatch.setattr(TaskContext, "get", staticmethod(lambda: None))
    assert next(write(iter([rows])))["ok"].all() and [len((tmp_path / "one" / f"x{k}.png").read_bytes()) for k in range(3)] == [1, 2, 3]


def decode_once(body: bytes):
    from boxframe.operators.fetch import decode_png

    return decode_png(body)
