"""Run a detector over image partitions; overlay rows for plots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions.geometry import box_xywh, caption

BOX = ("xmin", "ymin", "xmax", "ymax")


def overlay_rows(gt: DataFrame, det: DataFrame, score_threshold: float = 0.5, label_col: str = "LabelName") -> DataFrame:
    """Rows to draw: truth boxes (green, no caption) and predictions with
    ``score >= score_threshold`` (red, caption ``"{label} ({score:.2f})"``)."""
    gx, gy, gw, gh = box_xywh(BOX)
    truth = gt.select(
        "ImageID", F.lit("truth").alias("kind"), F.col("box_id").alias("obj_id"),
        gx.alias("x"), gy.alias("y"), gw.alias("w"), gh.alias("h"),
        F.lit(None).cast("string").alias("caption"), F.lit("green").alias("color"),
    )
    pred = det.where(F.col("score") >= score_threshold).select(
        "ImageID", F.lit("prediction").alias("kind"), F.col("det_id").alias("obj_id"),
        gx.alias("x"), gy.alias("y"), gw.alias("w"), gh.alias("h"),
        caption(label_col, "score").alias("caption"), F.lit("red").alias("color"),
    )
    return truth.unionByName(pred)


# ----------------------------------------------------------------- detector over image partitions

from collections.abc import Callable, Iterator  # noqa: E402

import numpy as np  # noqa: E402
import pandas as pd  # noqa: E402

from boxframe.operators.images import three_channels  # noqa: E402
from boxframe.schemas import DETECTIONS  # noqa: E402

Predict = Callable[[list], list]  # list of HWC RGB uint8 arrays -> list of (boxes[n,4], scores[n], labels[n])


def _detect_batches(make_predict: Callable[[], Predict], batch_size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        predict = make_predict()  # once per task: load weights here
        cols = {k: [] for k in ("ImageID", "det_id", "xmin", "ymin", "xmax", "ymax", "score", "label")}
        for pdf in batches:
            recs = list(zip(pdf["ImageID"], pdf["height"], pdf["width"], pdf["nChannels"], pdf["data"]))
            for s in range(0, len(recs), batch_size):
                chunk = recs[s:s + batch_size]
                imgs = []
                for _, h, w, c, buf in chunk:
                    imgs.append(three_channels(h, w, c, buf)[..., ::-1])  # BGR -> RGB
                for (iid, *_), (boxes, scores, labels) in zip(chunk, predict(imgs)):
                    for i in range(len(scores)):
                        cols["ImageID"].append(iid)
                        cols["det_id"].append(i)  # place in the image; hashed with the image's id outside of Python
                        for j, k in enumerate(("xmin", "ymin", "xmax", "ymax")):
                            cols[k].append(float(boxes[i][j]))
                        cols["score"].append(float(scores[i]))
                        cols["label"].append(int(labels[i]))
            if len(cols["ImageID"]) >= 10_000:
                yield pd.DataFrame(cols)
                cols = {k: [] for k in cols}
        if cols["ImageID"]:
            yield pd.DataFrame(cols)

    return run


def run_detector(pixels: DataFrame, make_predict: Callable[[], Predict], batch_size: int = 8) -> DataFrame:
    """Run a detector over decoded images (``ImageID, height, width, nChannels, data``)
    partition by partition; the output is long form, one predicted box per row
    (``DETECTIONS``). ``make_predict`` is called once per task so a model is
    loaded once per worker, not per image. Images with an ``error`` are skipped.
    """
    from boxframe.session import ship_package

    ship_package(pixels.sparkSession)
    ok = pixels.where(F.col("error").isNull() & F.col("data").isNotNull()) if "error" in pixels.columns else pixels
    found = ok.select("ImageID", "height", "width", "nChannels", "data").mapInPandas(
        _detect_batches(make_predict, batch_size), schema=DETECTIONS
    )
    unique = F.xxhash64("ImageID", "det_id").bitwiseAND(F.lit((1 << 63) - 1))
    return found.withColumn("det_id", unique).select([f.name for f in DETECTIONS.fields])


def bright_region_detector() -> Predict:
    """A small stand-in model: one box around the pixels brighter than the image mean,
    scored by their share. Any callable with the same signature plugs in."""

    def predict(images: list) -> list:
        out = []
        for img in images:
            g = img.astype(np.float32).mean(axis=-1) if img.ndim == 3 else img.astype(np.float32)
            mask = g > g.mean()
            if not mask.any():
                out.append((np.zeros((0, 4)), np.zeros(0), np.zeros(0, np.int64)))
                continue
            ys, xs = np.nonzero(mask)
            box = np.array([[xs.min(), ys.min(), xs.max() + 1, ys.max() + 1]], dtype=np.float64)
            out.append((box, np.array([float(mask.mean())]), np.array([0], np.int64)))
        return out

    return predict
