"""Continuous runs over arriving files."""

from .arrivals import run_stream, stream_into_table

__all__ = ["run_stream", "stream_into_table"]
