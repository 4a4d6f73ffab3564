"""Readers: play logs and catalogue as CSV, multi-part parquet, and the driver tables."""

from .catalogue import read_catalogue
from .parts import read_parts
from .plays import inspect_files, land_plays, read_plays

__all__ = [
    "inspect_files",
    "land_plays",
    "read_catalogue",
    "read_parts",
    "read_plays",
]
