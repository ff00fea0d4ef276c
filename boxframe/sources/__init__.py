"""Readers and writers."""

from boxframe.sources.readers import list_objects, read_annotations, read_image_list, read_images  # noqa: F401
from boxframe.sources.sinks import write_processed, write_quarantine  # noqa: F401
