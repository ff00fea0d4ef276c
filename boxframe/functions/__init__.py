"""Column-level functions (JVM-side expressions only)."""

from boxframe.functions.geometry import (  # noqa: F401
    area,
    box_xywh,
    caption,
    clamp_box,
    intersection,
    iou,
    to_pixel,
    valid_box,
)
from boxframe.functions.hashing import hash_order_key  # noqa: F401
from boxframe.functions.ids import (  # noqa: F401
    image_id_from_path,
    normalize_line,
    object_key,
    parse_split,
    parse_image_id,
    split_uri,
)
