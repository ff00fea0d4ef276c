"""Image-list lines, object keys and URIs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the original tool's for the same results:
# the recognised dataset splits and the id alphabet of an image list line.
SPLITS = ("test", "train", "validation", "challenge2018")
ID_CHARS = "[a-fA-F0-9]"
IMAGE_EXT = ".jpg"

_SPLIT_ALT = "|".join(SPLITS)
# Anchored at the start only: an id may be empty and trailing junk is cut.
LINE_PATTERN = f"^({_SPLIT_ALT})/({ID_CHARS}*)"
# Strict form: the whole line must be split/id with a non-empty id.
STRICT_PATTERN = f"^({_SPLIT_ALT})/({ID_CHARS}+)$"

# Python's str.strip() removes Unicode white space plus the separators 0x1C-0x1F.
_STRIP = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_line(line: Column | str, ext: str = IMAGE_EXT) -> Column:
    """Strip surrounding white space, then delete every occurrence of ``ext``."""
    return F.replace(F.regexp_replace(_c(line), _STRIP, ""), F.lit(ext), F.lit(""))


def _pattern(strict: bool) -> str:
    return STRICT_PATTERN if strict else LINE_PATTERN


def line_is_valid(norm: Column | str, strict: bool = False) -> Column:
    return _c(norm).rlike(_pattern(strict))


def parse_split(norm: Column | str, strict: bool = False) -> Column:
    return F.regexp_extract(_c(norm), _pattern(strict), 1)


def parse_image_id(norm: Column | str, strict: bool = False) -> Column:
    return F.regexp_extract(_c(norm), _pattern(strict), 2)


def object_key(prefix: str | Column, split: Column | str | None, image_id: Column | str, ext: str = IMAGE_EXT) -> Column:
    """``{prefix}{split}/{id}{ext}``, or ``{prefix}{id}{ext}`` without a split."""
    pre = F.lit(prefix) if isinstance(prefix, str) else prefix
    if split is None:
        return F.concat(pre, _c(image_id), F.lit(ext))
    return F.concat(pre, _c(split), F.lit("/"), _c(image_id), F.lit(ext))


def split_uri(uri: Column | str) -> tuple[Column, Column]:
    """``scheme://bucket/key`` -> (bucket, key), as ``uri.split('/', 3)[2:]``.

    ``parse_url`` is not used: it returns a NULL host for bucket names with ``_``.
    """
    parts = F.split(_c(uri), "/", 4)
    return F.get(parts, 2), F.get(parts, 3)


def image_id_from_path(path: Column | str, ext: str = IMAGE_EXT) -> Column:
    """Basename of an object path with every ``ext`` removed."""
    base = F.element_at(F.split(_c(path), "/"), -1)
    return F.replace(base, F.lit(ext), F.lit(""))
