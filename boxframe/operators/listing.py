"""Image lists: parse ``split/id`` lines, keep the rejects, derive object keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions.ids import line_is_valid, normalize_line, object_key, parse_image_id, parse_split


def parse_image_list(df: DataFrame, col: str = "value", strict: bool = False) -> DataFrame:
    """Lines -> ``line, split, image_id`` for the lines that parse.

    The default follows the original tool: strip, drop every ``.jpg``, match
    ``split/hexid`` at the start only (the id may be empty, trailing junk is
    cut). ``strict=True`` requires the whole line to match and a non-empty id.
    """
    norm = normalize_line(col)
    return (
        df.select(F.col(col).alias("line"), norm.alias("_n"))
        .where(line_is_valid("_n", strict))
        .select("line", parse_split("_n", strict).alias("split"), parse_image_id("_n", strict).alias("image_id"))
    )


def rejected_lines(df: DataFrame, col: str = "value", strict: bool = False) -> DataFrame:
    """Lines that do not parse (NULL lines included)."""
    norm = normalize_line(col)
    return df.select(F.col(col).alias("line")).where(~F.coalesce(line_is_valid(norm, strict), F.lit(False)))


def with_object_keys(parsed: DataFrame, src_prefix: str, dst_prefix: str, ext: str = ".jpg") -> DataFrame:
    """Add ``src_key = {src_prefix}{split}/{id}{ext}`` and ``dst_key`` likewise."""
    return parsed.withColumn("src_key", object_key(src_prefix, "split", "image_id", ext)).withColumn(
        "dst_key", object_key(dst_prefix, "split", "image_id", ext)
    )
