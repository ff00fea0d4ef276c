"""Incremental runs of the batch operators over arriving files (Structured Streaming)."""

from boxframe.streaming.incremental import incremental_download  # noqa: F401
