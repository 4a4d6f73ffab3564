"""Whole jobs: the three result tables, a run over arrived files, the run summary."""

from .run import finish_filing, read_tables, read_verdicts, run_files, run_inbox, table_paths
from .summary import (
    genres_in_order,
    kpis_by_listen_count,
    row_counts,
    show_summary,
    songs_in_order,
)
from .transform import KEYS, kpi_tables, song_key_columns, write_tables

__all__ = [
    "KEYS",
    "finish_filing",
    "genres_in_order",
    "kpi_tables",
    "kpis_by_listen_count",
    "read_tables",
    "read_verdicts",
    "row_counts",
    "run_files",
    "run_inbox",
    "show_summary",
    "song_key_columns",
    "songs_in_order",
    "table_paths",
    "write_tables",
]
