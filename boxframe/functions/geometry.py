"""Box geometry as column expressions.

Boxes are ``(x0, y0, x1, y1)`` with x1/y1 the right/bottom edges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple  # (x0, y0, x1, y1) columns


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_pixel(rel: Column | str, size: Column | str, target: int) -> Column:
    """``int(rel * size * (target / size))`` truncating toward zero.

    The operand order is kept on purpose: it differs from ``rel * target`` at
    the edges (e.g. 1.0 with width 275 gives 298). NULL stays NULL, NaN
    becomes NULL, and values beyond INT become its ends, so that a huge
    coordinate is clamped to the canvas like any other outside of it.
    """
    s = _c(size)
    v = _c(rel) * s * (F.lit(float(target)) / s)
    low, high = F.lit(float(-(1 << 31))), F.lit(float((1 << 31) - 1))
    return F.when(v.isNotNull() & ~F.isnan(v), F.greatest(low, F.least(high, v))).cast("int")


def clamp_box(x0: Column, y0: Column, x1: Column, y1: Column, width: int, height: int) -> Box:
    """Mins clamped below at 0, maxes above at the target size; nothing else.

    ``greatest``/``least`` skip NULLs, so NULL inputs are kept NULL explicitly.
    """

    def guard(v: Column, e: Column) -> Column:
        return F.when(v.isNotNull(), e)

    return (
        guard(x0, F.greatest(F.lit(0), x0)),
        guard(y0, F.greatest(F.lit(0), y0)),
        guard(x1, F.least(F.lit(width), x1)),
        guard(y1, F.least(F.lit(height), y1)),
    )


def valid_box(x0: Column | str, y0: Column | str, x1: Column | str, y1: Column | str) -> Column:
    """All four coordinates present and positive width and height."""
    x0, y0, x1, y1 = map(_c, (x0, y0, x1, y1))
    return (
        x0.isNotNull() & y0.isNotNull() & x1.isNotNull() & y1.isNotNull() & (x1 > x0) & (y1 > y0)
    )


def area(b: Box) -> Column:
    x0, y0, x1, y1 = map(_c, b)
    return (x1 - x0) * (y1 - y0)


def intersection(a: Box, b: Box) -> Column:
    ax0, ay0, ax1, ay1 = map(_c, a)
    bx0, by0, bx1, by1 = map(_c, b)
    w = F.greatest(F.lit(0), F.least(ax1, bx1) - F.greatest(ax0, bx0))
    h = F.greatest(F.lit(0), F.least(ay1, by1) - F.greatest(ay0, by0))
    return w * h


def iou(a: Box, b: Box) -> Column:
    """Intersection over union; 0 when the union is not positive."""
    inter = intersection(a, b)
    union = area(a) + area(b) - inter
    return F.when(union > 0, inter.cast("double") / union.cast("double")).otherwise(F.lit(0.0))


def box_xywh(b: Box) -> tuple[Column, Column, Column, Column]:
    """(x, y, width, height) of a box, for overlays."""
    x0, y0, x1, y1 = map(_c, b)
    return x0, y0, x1 - x0, y1 - y0


def caption(label: Column | str, score: Column | str) -> Column:
    """``"{label} ({score:.2f})"`` with the same rounding as Python formatting.

    ``format_number`` rounds half-even on the exact binary value like Python;
    ``format_string('%.2f')`` rounds half-up on the shortest decimal and
    differs at ties such as 0.145. Grouping commas are removed.
    """
    num = F.replace(F.format_number(_c(score), 2), F.lit(","), F.lit(""))
    return F.concat(_c(label).cast("string"), F.lit(" ("), num, F.lit(")"))
