"""Keep rows whose image exists; report the ones that do not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxframe.functions.ids import image_id_from_path


def listing_ids(listing: DataFrame, path_col: str = "path", ext: str = ".jpg") -> DataFrame:
    """Object listing -> ``path, image_id`` for names ending in ``ext``."""
    return listing.where(F.col(path_col).endswith(ext)).select(
        F.col(path_col).alias("path"), image_id_from_path(path_col, ext).alias("image_id")
    )


def with_existing_images(df: DataFrame, ids: DataFrame, key: str = "ImageID", id_col: str = "image_id") -> DataFrame:
    """Semi join: rows whose ``key`` is in the listing. NULL keys never match.

    A join instead of an ``isin`` literal list: the listing can be as large as
    the table, and the planner can choose broadcast or sort-merge by size.
    """
    right = ids.select(F.col(id_col).alias("_id"))
    return df.join(right, df[key] == right["_id"], "left_semi")


def missing_images(df: DataFrame, ids: DataFrame, key: str = "ImageID", id_col: str = "image_id") -> DataFrame:
    """Anti join: rows whose image is not in the listing."""
    right = ids.select(F.col(id_col).alias("_id"))
    return df.join(right, df[key] == right["_id"], "left_anti")


def join_images(df: DataFrame, images: DataFrame, key: str = "ImageID", how: str = "inner") -> DataFrame:
    """Equi join of rows with their image (``how='left'`` keeps rows without one)."""
    return df.join(images, key, how)
