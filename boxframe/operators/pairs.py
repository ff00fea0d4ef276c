"""Truth x prediction box pairs with positive overlap, via a spatial grid join.

An equi join on the image alone enumerates every truth-prediction pair of an
image, which is quadratic for an image with very many boxes. Here each box is
replicated to the grid cells it covers and the join key is
``(image, cell_x, cell_y)``; a pair is kept only in the cell holding the
lower corner of its intersection, so each overlapping pair appears exactly
once and non-overlapping boxes in far cells are never compared. The work is
proportional to the boxes' cell coverage plus the pairs that really overlap.

By default only images with very many candidate pairs take a grid, the others
stay joined per image. That grid has a level per power of two: a box is
entered in the cells of its own size (four at most), and probes the cells of
the larger levels that its image's boxes of the other side have, four at most each. So boxes of any sizes
meet in cells no smaller than the larger one, and no box is spread over many.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions.geometry import intersection, iou
from boxframe.session import cut_lineage, cut_lineage_counted
from boxframe.sources.bucketed import Bucketed

# The plain per-image join is used while the worst image's truth x prediction
# candidates stay below this; beyond it the grid join takes over.
MAX_CANDIDATES_PER_IMAGE = 1_000_000
TARGET_BOXES_PER_CELL = 1_000
MAX_BROADCAST_IMAGES = 100_000
BOX = ("xmin", "ymin", "xmax", "ymax")
MAX_LEVEL = 1_100  # beyond the level of any double


def choose_cell(gt: DataFrame, det: DataFrame, key: str, gt_box, det_box,
                max_candidates: int = MAX_CANDIDATES_PER_IMAGE, target_per_cell: int = TARGET_BOXES_PER_CELL):
    """``None`` (join per image) when every image's candidate pairs are bounded, else a grid cell size.

    One aggregate job gives the worst image's candidate count; only for the
    grid a second one gives the extent and median box size, so that a hot image spreads
    over about ``n / target_per_cell`` cells without replicating typical
    boxes into many cells.
    """
    sides = gt.select(F.col(key).alias("_k"), F.lit(1).alias("_g")).unionByName(
        det.select(F.col(key).alias("_k"), F.lit(0).alias("_g"))
    )
    per = sides.groupBy("_k").agg(F.sum("_g").alias("g"), F.count(F.lit(1)).alias("n"))
    worst = per.agg(
        F.max(F.col("g") * (F.col("n") - F.col("g"))).alias("cand"), F.max("g").alias("mg"), F.max(F.col("n") - F.col("g")).alias("md")
    ).first()
    mg, md = worst.mg or 0, worst.md or 0
    if (worst.cand or 0) <= max_candidates:
        return None
    x0, y0, x1, y1 = (F.col(c) for c in gt_box)
    st = gt.agg(
        F.percentile_approx(F.greatest(x1 - x0, y1 - y0), 0.5).alias("med"),
        F.min(x0).alias("lx"), F.max(x1).alias("hx"), F.min(y0).alias("ly"), F.max(y1).alias("hy"),
    ).first()
    extent = max(float(st.hx - st.lx), float(st.hy - st.ly), 1.0)
    per_side = math.ceil(math.sqrt(max(mg, md) / target_per_cell))
    return max(extent / per_side, float(st.med or 1.0), 1.0)


def _with_cells(df: DataFrame, box: tuple[str, str, str, str], cell: float, prefix: str) -> DataFrame:
    x0, y0, x1, y1 = (F.col(c) for c in box)
    c = F.lit(float(cell))
    positive = (x1 > x0) & (y1 > y0)  # a box without positive extent overlaps nothing
    d = df.where(positive)
    d = d.withColumn(f"{prefix}cx", F.explode(F.sequence(F.floor(x0 / c), F.ceil(x1 / c) - 1)))
    d = d.withColumn(f"{prefix}cy", F.explode(F.sequence(F.floor(y0 / c), F.ceil(y1 / c) - 1)))
    return d


def hot_images(gt: DataFrame, det: DataFrame, key: str = "ImageID",
               max_candidates: int = MAX_CANDIDATES_PER_IMAGE, levels: bool = False) -> DataFrame | None:
    """``_k``: the images of more than ``max_candidates`` truth x prediction candidates, as a written table; ``None`` without any.

    ``levels`` adds ``_gl, _dl``, the levels of each side's boxes (``BOX``), which ``overlap_pairs`` otherwise
    looks up by another pass over the boxes of these images: for tables of which many images are hot.
    """
    def side(df: DataFrame, truth: int) -> DataFrame:
        level = [F.coalesce(_level(BOX), F.lit(0)).alias("_l")] if levels else []
        return df.select(F.col(key).alias("_k"), F.lit(truth).alias("_g"), *level)

    def of_side(truth: int) -> list:
        mine = F.col("_g") == truth
        bits = F.bit_or(F.when(mine, F.expr("shiftleft(1L, least(_l, 62))")))
        return [F.coalesce(bits, F.lit(0).cast("bigint")).alias(f"_b{truth}"), F.coalesce(F.max(F.when(mine, F.col("_l"))), F.lit(0)).alias(f"_m{truth}")]

    per = side(gt, 1).unionByName(side(det, 0)).groupBy("_k").agg(
        F.sum("_g").alias("g"), F.count(F.lit(1)).alias("n"), *(of_side(1) + of_side(0) if levels else []))
    # bit 62 stands for all levels from there on: one that no box has does no harm
    found_levels = [F.expr(f"filter(sequence(0, _m{k}), x -> x >= 62 or (shiftright(_b{k}, x) & 1) = 1)").alias(name)
                    for k, name in ((1, "_gl"), (0, "_dl"))] if levels else []
    hot, found = cut_lineage_counted(
        per.where(F.col("g") * (F.col("n") - F.col("g")) > max_candidates).select("_k", *found_levels), "hot-images")
    if not found:
        return None
    return F.broadcast(hot) if found <= MAX_BROADCAST_IMAGES else hot


def _level(box: tuple[str, str, str, str]):
    x0, y0, x1, y1 = (F.col(c) for c in box)
    return F.least(F.ceil(F.log2(F.greatest(x1 - x0, y1 - y0, F.lit(1.0)))), F.lit(MAX_LEVEL)).cast("int")


def level_cells(df: DataFrame, box: tuple[str, str, str, str], levels: DataFrame, image: str, prefix: str) -> DataFrame:
    """Boxes of hot images with their cells: ``{prefix}l, {prefix}x, {prefix}y`` and ``{prefix}own`` at the box's own level.

    ``levels`` has the levels of each image (``_k, _levels``) that boxes may meet at: those of the other
    side's boxes. A box gets at most four cells of its own level and of each larger one of them.
    """
    x0, y0, x1, y1 = (F.col(c) for c in box)
    d = df.where((x1 > x0) & (y1 > y0)).withColumn("_own", _level(box))
    d = d.join(levels.select(F.col("_k").alias("_image"), "_levels"), F.col(image) == F.col("_image")).drop("_image")
    d = d.withColumn(f"{prefix}l", F.explode(F.filter(F.array_union("_levels", F.array("_own")), lambda x: x >= F.col("_own")))).drop("_levels")
    c = F.pow(F.lit(2.0), F.col(f"{prefix}l"))
    d = d.withColumn(f"{prefix}own", F.col(f"{prefix}l") == F.col("_own")).drop("_own")
    d = d.withColumn(f"{prefix}x", F.explode(F.sequence(F.floor(x0 / c), F.ceil(x1 / c) - 1)))
    return d.withColumn(f"{prefix}y", F.explode(F.sequence(F.floor(y0 / c), F.ceil(y1 / c) - 1)))


def overlap_pairs(
    gt: DataFrame,
    det: DataFrame,
    key: str = "ImageID",
    gt_id: str = "box_id",
    det_id: str = "det_id",
    gt_box: tuple[str, str, str, str] = ("xmin", "ymin", "xmax", "ymax"),
    det_box: tuple[str, str, str, str] = ("xmin", "ymin", "xmax", "ymax"),
    same: str | None = None,
    gt_cols: tuple[str, ...] = (),
    det_cols: tuple[str, ...] = (),
    cell: float | str | None | DataFrame = "auto",
) -> DataFrame:
    """Pairs ``(key, gt_id, det_id, iou, *gt_cols, *det_cols)`` with intersection > 0.

    ``same`` adds an equality on that column (e.g. the class label).
    Column names of ``gt_cols`` and ``det_cols`` must differ. ``cell``:
    ``"auto"`` looks for hot images and gives them levelled grids, a frame of
    ``hot_images`` does so for these images, ``None`` joins per image, a number
    uses one grid of that cell size for all.
    """
    if isinstance(cell, str):
        cell = auto_cell(gt, det, key)
    g = gt.select(
        F.col(key).alias("_k"),
        F.col(gt_id).alias(gt_id),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(gt_box)],
        *([F.col(same).alias("_gs")] if same else []),
        *gt_cols,
    )
    d = det.select(
        F.col(key).alias("_k2"),
        F.col(det_id).alias(det_id),
        *[F.col(c).alias(f"_d{i}") for i, c in enumerate(det_box)],
        *([F.col(same).alias("_ds")] if same else []),
        *det_cols,
    )
    a = tuple(F.col(f"_g{i}") for i in range(4))
    b = tuple(F.col(f"_d{i}") for i in range(4))

    def meet(g: DataFrame, d: DataFrame, *extra) -> DataFrame:
        cond = g["_k"] == d["_k2"]
        for e in extra:
            cond = cond & e
        if same:
            cond = cond & (g["_gs"] == d["_ds"])
        j = g.join(d, cond & (intersection(a, b) > 0), "inner")
        return j.select(F.col("_k").alias(key), gt_id, det_id, iou(a, b).alias("iou"), *gt_cols, *det_cols)

    def corner(c, x: str, y: str) -> list:
        """The cell of the intersection's lower corner: each pair is kept once."""
        return [F.floor(F.greatest(a[0], b[0]) / c) == F.col(x), F.floor(F.greatest(a[1], b[1]) / c) == F.col(y)]

    if cell is None:
        return meet(g, d)
    if not isinstance(cell, DataFrame):
        g = _with_cells(g, ("_g0", "_g1", "_g2", "_g3"), cell, "_g")
        d = _with_cells(d, ("_d0", "_d1", "_d2", "_d3"), cell, "_d")
        return meet(g, d, g["_gcx"] == d["_dcx"], g["_gcy"] == d["_dcy"], *corner(F.lit(float(cell)), "_gcx", "_gcy"))
    # Both ways read the same rows, so that their exchanges are one; a box without extent overlaps nothing.
    g, d = (x.where((c[2] > c[0]) & (c[3] > c[1])) for x, c in ((g, a), (d, b)))
    images = cell.select("_k")
    rest = meet(g.join(images, "_k", "left_anti"), d.join(images, F.col("_k2") == F.col("_k"), "left_anti"))
    g_hot, d_hot = g.join(images, "_k", "left_semi"), d.join(images, F.col("_k2") == F.col("_k"), "left_semi")
    if {"_gl", "_dl"} <= set(cell.columns) and gt_box == det_box == BOX:
        levels = cell.select("_k", F.col("_gl").alias("g"), F.col("_dl").alias("d"))
    else:
        none = F.lit(None).cast("int")
        sizes = g_hot.select("_k", _level(("_g0", "_g1", "_g2", "_g3")).alias("g"), none.alias("d")).unionByName(
            d_hot.select(F.col("_k2").alias("_k"), none.alias("g"), _level(("_d0", "_d1", "_d2", "_d3")).alias("d")))
        levels = cut_lineage(sizes.groupBy("_k").agg(F.collect_set("g").alias("g"), F.collect_set("d").alias("d")), "hot-levels")
    g_hot = level_cells(g_hot, ("_g0", "_g1", "_g2", "_g3"), levels.select("_k", F.col("d").alias("_levels")), "_k", "_g")
    d_hot = level_cells(d_hot, ("_d0", "_d1", "_d2", "_d3"), levels.select("_k", F.col("g").alias("_levels")), "_k2", "_d")
    # At the larger box's own level, and there only, one of the two is at home.
    hot = meet(g_hot, d_hot, g_hot["_gl"] == d_hot["_dl"], g_hot["_gx"] == d_hot["_dx"], g_hot["_gy"] == d_hot["_dy"],
               g_hot["_gown"] | d_hot["_down"], *corner(F.pow(F.lit(2.0), F.col("_gl")), "_gx", "_gy"))
    return rest.unionByName(hot)


def bucketed_pairs(gt: Bucketed, det: Bucketed, **kw) -> DataFrame:
    """``overlap_pairs`` of two tables in equal buckets of the image: no exchange but for crowded images.

    An image within both tables' buckets has a bounded number of candidates, so
    nothing is counted. Images crowded in either table are joined apart, on grids where they are hot.
    """
    key = gt.key
    pairs = overlap_pairs(gt.buckets, det.buckets, key=key, cell=None, **kw)
    if not gt.crowded and not det.crowded:
        return pairs
    keys = cut_lineage(gt.crowded_keys().union(det.crowded_keys()).distinct(), "crowded-images")
    return pairs.unionByName(overlap_pairs(gt.rows_of(keys), det.rows_of(keys), key=key, **kw))


def auto_cell(gt: DataFrame, det: DataFrame, key: str = "ImageID") -> DataFrame | None:
    """``hot_images``, remembered per input plan: it only chooses between ways to the same pairs."""
    from boxframe.operators.stats import memo

    return memo(f"hot:{key}", [gt, det], lambda: hot_images(gt, det, key))
