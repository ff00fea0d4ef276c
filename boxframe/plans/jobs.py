"""The end-to-end jobs: download, preprocess, prepare training data, evaluate.

Each job is a function of a session and paths (no module-level state, no
hard-coded stores). Side effects inside tasks (copies, image writes) are
idempotent, so task retries and lost executors only repeat work. Tables that
later steps read twice are written to the shared checkpoint folder first.
"""

from __future__ import annotations

from contextlib import nullcontext
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.operators import boxes as B
from boxframe.operators import metrics as M
from boxframe.operators.batches import epoch_plan, partition_by_shard, plan_batches
from boxframe.operators.fetch import NOT_FOUND, decode_png, fetch_and_write, image_paths
from boxframe.operators.images import arrow_batches, encode_png, image_rows, write_images
from boxframe.operators.labels import build_vocabulary, training_targets
from boxframe.operators.listing import parse_image_list, rejected_lines
from boxframe.operators.pairs import bucketed_pairs
from boxframe.operators.presence import missing_images, with_existing_images
from boxframe.operators.split import split_by_hash
from boxframe.operators.transfer import transfer_summary
from boxframe.schemas import MANIFEST
from boxframe.session import cut_lineage
from boxframe.sources.bucketed import Bucketed, read_bucketed, write_bucketed
from boxframe.sources.copy_sink import copy_with_manifest
from boxframe.sources.readers import read_image_list, read_images, split_annotations, walk_objects
from boxframe.sources.sinks import write_processed, write_quarantine


# ----------------------------------------------------------------- E1 download


def download_job(spark: SparkSession, list_path: str, src_root: str, dst_root: str, manifest_path: str,
                 ext: str = ".jpg", strict: bool = False, options: dict | None = None) -> DataFrame:
    """Parse the image list, copy the objects, write the manifest; returns the per-split summary.

    ``options`` configures the stores (unsigned reads, for one; see
    ``sources.fs.arrow_fs``). Rejected lines are written next to the manifest (``{manifest_path}_rejected``).
    """
    lines = read_image_list(spark, list_path)
    parsed = parse_image_list(lines, "value", strict=strict)
    spark.createDataFrame([], MANIFEST).write.mode("overwrite").parquet(manifest_path)  # this run's rows alone
    manifest = copy_with_manifest(parsed, src_root, dst_root, manifest_path, ext=ext, options=options)
    rejected_lines(lines, "value", strict=strict).write.mode("overwrite").parquet(f"{manifest_path}_rejected")
    return transfer_summary(manifest)


# ----------------------------------------------------------------- E2 preprocess


@dataclass
class PreprocessOutput:
    processed: DataFrame
    quarantine: DataFrame


def preprocess_job(
    spark: SparkSession,
    csv_path: str,
    image_dir: str,
    resized_dir: str,
    output_path: str,
    quarantine_path: str,
    size: tuple[int, int] = (299, 299),
    ext_in: str = ".jpg",
    ext_out: str = ".png",
    encoder=encode_png,
    decoder=None,
    options: dict | None = None,
    buckets: int | None = None,
) -> PreprocessOutput:
    """Annotations + images -> resized images, pixel boxes (processed table) and a quarantine table.

    Boxes stay in long form until the sink; an image with a NULL/NaN
    coordinate, without a decodable file or whose resized file could not be
    written goes to quarantine as a whole. Every image is decoded once: one
    pass resizes, encodes and writes it and reports its size and status, and
    that small table serves boxes and quarantine. ``encoder`` must give the
    bytes that ``ext_out`` promises; ``options`` configures the stores.

    With a ``decoder`` (bytes to BGR array), or PNGs, images are read by key in
    the task that resizes them, so no pixels are joined or shuffled. Other
    formats without a ``decoder`` are decoded by Spark's image source, whose
    rows are joined to the wanted ids.

    Lines that don't fit the annotation schema are written to
    ``{quarantine_path}_lines`` as they stand.

    With ``buckets`` the processed table is written in that many buckets of the
    image (images spread over several rows beside them), which the training
    job can join without an exchange of the boxes.
    """
    ann, rejects = split_annotations(spark, csv_path)
    rejects.write.mode("overwrite").parquet(f"{quarantine_path}_lines")
    # A line that can't be read is a box without coordinates: its image goes to quarantine as a whole.
    ann = ann.unionByName(rejects.select("ImageID", *[F.lit(None).cast("double").alias(c) for c in ann.columns[1:5]], F.lit(None).cast("string").alias("LabelName")))
    # ids only on the annotation side; images with a bad coordinate are looked at but not written
    wanted = ann.groupBy("ImageID").agg((~F.max(B.bad_coordinate())).alias("wanted"))
    late = bool(decoder) or ext_in == ".png"
    with nullcontext() if late else arrow_batches(spark):  # rows of late images hold no pixels
        if late:
            rows = image_paths(wanted.where("ImageID is not null"), image_dir, ext_in)
            written = fetch_and_write(rows, resized_dir, ext_out, size, encoder, decoder or decode_png, options)
        else:
            pixels = image_rows(read_images(spark, image_dir), ext=ext_in)
            written = write_images(pixels.join(wanted, "ImageID"), resized_dir, ext_out, size, encoder, "wanted", options)
        status = cut_lineage(written, "written")
    status = status.where(~F.col("error").eqNullSafe(NOT_FOUND))
    scaled = B.scale_boxes(ann, status.select("ImageID", "width", "height", "error"), size)
    processed = B.to_processed(scaled.result, resized_dir.rstrip("/") + "/", ext=ext_out)
    write_quarantine(scaled.quarantine, quarantine_path)
    if buckets:
        table = write_bucketed(cut_lineage(processed, "processed"), output_path, "ImageID", buckets, max_rows_per_key=1)
        return PreprocessOutput(table.rows, spark.read.parquet(quarantine_path))
    write_processed(processed, output_path)
    return PreprocessOutput(spark.read.parquet(output_path), spark.read.parquet(quarantine_path))


# ----------------------------------------------------------------- E3 prepare training data


def long_boxes(processed: DataFrame) -> DataFrame:
    """Processed table -> one box per row with a box id (xxhash64 of image, chunk and position).

    An image spread over several rows keeps its boxes apart by ``chunk``.
    """
    e = B.explode_annotations(processed, "Annotations")
    place = ["ImageID", *(["chunk"] if "chunk" in e.columns else []), "pos"]
    return e.select(
        "ImageID",
        F.xxhash64(*place).alias("box_id"),
        "LabelName",
        F.col("XMin").alias("xmin"), F.col("YMin").alias("ymin"),
        F.col("XMax").alias("xmax"), F.col("YMax").alias("ymax"),
    )


def targets_by_part(parts: list[DataFrame], vocab: DataFrame) -> DataFrame:
    """Training targets of long boxes in parts that share no image: a bucketed part is grouped where it lies."""
    return reduce(DataFrame.unionByName, [training_targets(B.drop_invalid(p), vocab) for p in parts])


def prepare_training_job(
    spark: SparkSession,
    processed_path: str,
    image_dir: str,
    out_dir: str,
    world_size: int = 1,
    batch_size: int = 8,
    epochs: int = 5,
    seed: int = 42,
    train_fraction: float = 0.8,
    image_ext: str = ".png",
    options: dict | None = None,
    bucketed: bool = False,
) -> dict[str, DataFrame]:
    """Keep images that exist, build the vocabulary, encode targets, split, and plan batches.

    Writes ``vocabulary``, ``targets``, ``split``, ``train_batches`` (per
    epoch, partitioned by epoch and shard), ``test_batches`` and
    ``missing_images`` under ``out_dir``. ``bucketed``: the processed table was
    written in buckets; only the listing is shuffled to meet it.
    """
    if bucketed:
        table = read_bucketed(spark, processed_path)
        processed, parts = table.rows, table.parts()
    else:
        processed = spark.read.parquet(processed_path)
        parts = [processed]
    listing = walk_objects(spark, image_dir, ext=image_ext, stores=options)
    out: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        w = df.write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(f"{out_dir}/{name}")
        # read back with the known schema: an empty result has no files to infer from
        out[name] = spark.read.schema(df.schema).parquet(f"{out_dir}/{name}")
        return out[name]

    put("missing_images", missing_images(processed.select("ImageID"), listing))
    boxes = [long_boxes(with_existing_images(p, listing)) for p in parts]
    vocab = put("vocabulary", build_vocabulary(reduce(DataFrame.unionByName, [b.select("LabelName") for b in boxes])))
    t = put("targets", targets_by_part(boxes, vocab))
    s = put("split", split_by_hash(t.select("ImageID").distinct(), train_fraction=train_fraction, seed=seed))
    train = s.where(F.col("split") == "train").select("ImageID")
    test = s.where(F.col("split") == "test").select("ImageID")
    train_plan = partition_by_shard(epoch_plan(train, epochs, "ImageID", world_size, batch_size, seed=seed), ["epoch"])
    put("train_batches", train_plan, ["epoch", "shard"])
    put("test_batches", partition_by_shard(plan_batches(test, "ImageID", world_size, batch_size)), ["shard"])
    return out


# ----------------------------------------------------------------- evaluate


def evaluate_job(
    spark: SparkSession,
    truth: DataFrame | Bucketed,
    detections: DataFrame | Bucketed,
    out_dir: str,
    iou_threshold: float = 0.5,
    count_mode: str = "per_image",
    matching: str = "coco",
    max_dets: int | None = None,
) -> dict[str, DataFrame]:
    """All detection metrics for long-form truth and detections; each written under ``out_dir``.

    ``truth``: ``ImageID, box_id, LabelName, xmin..ymax``;
    ``detections``: ``ImageID, det_id, LabelName, score, xmin..ymax``.
    The pair table is written once and read by every metric. ``matching``
    and ``max_dets`` choose the AP protocol (greedy COCO matching by default;
    ``max_dets=100`` is that protocol's usual limit). Truth and detections
    that were both written in the same number of buckets of the image meet there, without exchanges.
    """
    if isinstance(truth, Bucketed) and isinstance(detections, Bucketed):
        valid = truth.map(B.drop_invalid)
        pairs = cut_lineage(bucketed_pairs(valid, detections), "pairs")
        gt, detections = valid.rows, detections.rows
    else:
        truth, detections = (x.rows if isinstance(x, Bucketed) else x for x in (truth, detections))
        gt = B.drop_invalid(truth)
        pairs = cut_lineage(M.iou_pairs(gt, detections), "pairs")
    best = M.best_iou(gt, pairs)
    counts = M.detection_counts(gt, detections, pairs, iou_threshold, mode=count_mode)
    prf = M.prf_per_image(counts)
    matches = M.match_one_to_one(pairs, iou_threshold)
    out = {
        "best_iou": best,
        "counts": counts,
        "prf_per_image": prf,
        "macro": M.macro_summary(best, prf),
        "weighted": M.weighted_prf_matched(gt, detections, matches),
        "average_precision": M.average_precision(gt, detections, matching=matching, max_dets=max_dets),
    }
    out["map"] = M.mean_average_precision(out["average_precision"])
    for name, df in out.items():
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}")
    return {name: spark.read.parquet(f"{out_dir}/{name}") for name in out}
