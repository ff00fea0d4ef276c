"""Annotation grouping, pixel scaling, clamping and box validity.

The long form (one box per row) is the working form: it joins, filters and
aggregates without ever holding an image's boxes in one row. The grouped form
(one row per image, ``Annotations`` array) is produced only at the sink, where
the processed-table schema asks for it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxframe.functions.geometry import clamp_box, to_pixel, valid_box

REL_COLS = ("XMin", "YMin", "XMax", "YMax")
PIX_COLS = ("xmin", "ymin", "xmax", "ymax")


@dataclass
class ScaleResult:
    result: DataFrame  # long form, pixel boxes of good images
    quarantine: DataFrame  # (ImageID, error) of images that could not be processed


def bad_coordinate(cols: tuple[str, ...] = REL_COLS) -> Column:
    """NULL, NaN or infinite: ``int()`` of such a value fails, which fails the whole image."""
    cond = F.lit(False)
    for c in cols:
        x = F.col(c)
        cond = cond | x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return cond


def image_status(boxes: DataFrame, image_meta: DataFrame, key: str = "ImageID") -> DataFrame:
    """One row per annotated image: ``key, width, height, error`` (error NULL when fine).

    An image fails as a whole when any of its boxes has a NULL/NaN coordinate,
    when it has no entry in ``image_meta`` (not found / not decodable), or when
    its size is not positive. The per-image flag is a partial+final aggregate,
    so an image holding a third of all boxes is reduced map-side.
    """
    flags = boxes.groupBy(key).agg(F.max(bad_coordinate().cast("int")).alias("_bad"))
    # an ``error`` column in image_meta (e.g. a decode failure) is reported as is
    meta_err = F.col("error") if "error" in image_meta.columns else F.lit(None).cast("string")
    meta = image_meta.select(key, "width", "height", meta_err.alias("_merr"), F.lit(True).alias("_found"))
    joined = flags.join(meta, key, "left")
    error = (
        F.when(F.col("_found").isNull(), F.lit("image not found"))
        .when(F.col("_merr").isNotNull(), F.col("_merr"))
        .when(~_good_size(), F.lit("bad image size"))
        .when(F.col("_bad") == 1, F.lit("null or NaN coordinate"))  # also infinite
    )
    return joined.select(key, "width", "height", error.alias("error"))


def _good_size() -> Column:
    return F.coalesce((F.col("width") > 0) & (F.col("height") > 0), F.lit(False))


def good_images(boxes: DataFrame, image_meta: DataFrame, key: str = "ImageID") -> DataFrame:
    """``key, width, height`` of the images that ``image_status`` finds fine, annotated or not.

    Only the images with a bad coordinate are collected, not a flag of each annotated one.
    """
    usable = image_meta.where("error is null") if "error" in image_meta.columns else image_meta
    bad = boxes.where(bad_coordinate()).select(key).distinct()
    return usable.where(_good_size()).select(key, "width", "height").join(bad, key, "left_anti")


def scale_boxes(
    boxes: DataFrame,
    image_meta: DataFrame,
    size: tuple[int, int] = (299, 299),
    key: str = "ImageID",
) -> ScaleResult:
    """Relative boxes -> pixel boxes in a ``size`` canvas, clamped, long form.

    ``boxes``: ``key, XMin, YMin, XMax, YMax`` (+ any columns, passed through).
    ``image_meta``: ``key, width, height`` of the original images.
    Result: passthrough columns + ``xmin, ymin, xmax, ymax`` (INT).
    """
    tw, th = size
    quarantine = image_status(boxes, image_meta, key).where(F.col("error").isNotNull()).select(key, "error")

    j = boxes.join(good_images(boxes, image_meta, key), key, "inner")
    w, h = F.col("width"), F.col("height")
    x0 = to_pixel("XMin", w, tw)
    y0 = to_pixel("YMin", h, th)
    x1 = to_pixel("XMax", w, tw)
    y1 = to_pixel("YMax", h, th)
    cx0, cy0, cx1, cy1 = clamp_box(x0, y0, x1, y1, tw, th)
    keep = [c for c in boxes.columns if c not in REL_COLS]
    result = j.select(*keep, cx0.alias("xmin"), cy0.alias("ymin"), cx1.alias("xmax"), cy1.alias("ymax"))
    return ScaleResult(result=result, quarantine=quarantine)


def drop_invalid(df: DataFrame, cols: tuple[str, ...] = PIX_COLS) -> DataFrame:
    """Keep boxes with four coordinates and positive width and height."""
    return df.where(valid_box(*cols))


def images_with_boxes(valid: DataFrame, key: str = "ImageID") -> DataFrame:
    """Images left with at least one valid box, with their box count."""
    return valid.groupBy(key).agg(F.count(F.lit(1)).alias("n_boxes"))


# An image with more boxes than this is spread over several rows (``chunk``).
MAX_BOXES_PER_ROW = 100_000
# Hot-image lists up to this many rows are broadcast (checked by a count).
MAX_BROADCAST_HOT = 1_000_000
# Boxes that one task groups, about: beyond it a table gets more partitions than the session's.
ROWS_PER_TASK = 500_000


def deal(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """``df`` of ``rows`` rows dealt by ``cols`` over so many tasks that none groups much more than ``ROWS_PER_TASK``."""
    parts = -(-rows // ROWS_PER_TASK)
    return df.repartition(parts, *cols) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def group_annotations(
    df: DataFrame,
    fields: tuple[str, ...],
    order_by: str | None = None,
    key: str = "ImageID",
    out: str = "annotations",
    max_per_row: int | None = MAX_BOXES_PER_ROW,
    largest: int | None = None,
) -> DataFrame:
    """One row per image with an array of box structs, plus ``chunk`` (0 unless split).

    ``order_by`` gives the array a fixed order (sorted by that column, which
    is not kept in the struct). An image with more than ``max_per_row``
    boxes is spread over ``ceil(n / max_per_row)`` rows by a hash of its
    boxes, so no row, task or group holds an unbounded list; every box is
    kept. One map-side-combined count gives the largest image; only if it
    exceeds the bound are the hot images listed, and that list is broadcast
    after its size is checked, so ordinary images are grouped with a single
    shuffle on ``(key, chunk)``. ``largest`` passes that count when the
    caller knows it (e.g. from the same boxes before a lookup join). Tables of
    very many boxes are dealt over more tasks than the session's partitions (``deal``).
    """
    sort_key = [F.col(order_by).alias("_k")] if order_by else []
    item = F.struct(*sort_key, *[F.col(f) for f in fields])
    rows = 0
    if largest is None and max_per_row is not None:
        largest, rows = _image_sizes(df, key)
    by, chunk = [key], F.lit(0).alias("chunk")
    if max_per_row is None or largest <= max_per_row:
        src = df
    else:
        by, chunk = [key, "chunk"], F.col("chunk")
        from boxframe.session import cut_lineage_counted

        rows = rows or _image_sizes(df, key)[1]
        counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        hot, n_hot = cut_lineage_counted(
            counts.where(F.col("_n") > max_per_row).select(
                F.col(key), F.ceil(F.col("_n") / F.lit(max_per_row)).cast("int").alias("_chunks")
            ),
            "hot-images",
        )
        if n_hot <= MAX_BROADCAST_HOT:
            hot = F.broadcast(hot)
        spread = F.xxhash64(*([order_by] if order_by else list(fields)))
        src = df.join(hot, key, "left").withColumn(
            "chunk", F.coalesce(F.pmod(spread, F.col("_chunks")).cast("int"), F.lit(0))
        ).drop("_chunks")
    agg = deal(src, rows, *by).groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("_a"))
    if order_by:
        arr = F.transform("_a", lambda s: F.struct(*[s[f].alias(f) for f in fields]))
    else:
        arr = F.col("_a")
    return agg.select(key, chunk, arr.alias(out))


def _image_sizes(df: DataFrame, key: str) -> tuple[int, int]:
    """Boxes of the largest image and of all. Counted anew each time: the result depends on it, and the files behind a plan can change."""
    found = df.groupBy(key).count().agg(F.max("count").alias("largest"), F.sum("count").alias("rows")).first()
    return found.largest or 0, found.rows or 0


def explode_annotations(df: DataFrame, col: str = "annotations", key: str = "ImageID") -> DataFrame:
    """Grouped form back to long form with the array position ``pos`` (and ``chunk``, if the rows have one)."""
    keep = [key, *(["chunk"] if "chunk" in df.columns else [])]
    return df.select(*keep, F.posexplode(col).alias("pos", "_a")).select(*keep, "pos", "_a.*")


def to_processed(scaled: DataFrame, resized_dir: str, key: str = "ImageID", order_by: str | None = None, ext: str = ".jpg") -> DataFrame:
    """Long-form pixel boxes -> the processed table (``ImageID, Annotations, FilePath``)."""
    renamed = scaled.select(
        key,
        *([order_by] if order_by else []),
        F.col("xmin").alias("XMin"),
        F.col("ymin").alias("YMin"),
        F.col("xmax").alias("XMax"),
        F.col("ymax").alias("YMax"),
        "LabelName",
    )
    g = group_annotations(renamed, ("XMin", "YMin", "XMax", "YMax", "LabelName"), order_by=order_by, key=key, out="Annotations")
    return g.select(key, "Annotations", F.concat(F.lit(resized_dir), F.col(key), F.lit(ext)).alias("FilePath"), "chunk")
