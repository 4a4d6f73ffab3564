"""DataFrame operators: enrich, aggregate, rank, check, route, upsert, serve."""

from .enrich import catalogue_fits, enrich, ready_catalogue
from .items import to_documents, to_items
from .kpis import (
    daily_genre_kpis,
    kpis_of_enriched,
    song_play_counts,
    top_genres_per_day,
    top_songs_per_genre,
)
from .layouts import TIME_LAYOUTS, file_layouts, in_file_layouts
from .quality import profile_files, validate_files
from .routing import route_files
from .serve import date_top_genres, genre_dates, genre_date_top_songs, genre_day
from .topk import first_n_per_group, latest_per_key, top_k_per_group
from .upsert import DuplicateKeyError, read_keyed, upsert_by_key

__all__ = [
    "DuplicateKeyError",
    "TIME_LAYOUTS",
    "catalogue_fits",
    "daily_genre_kpis",
    "date_top_genres",
    "enrich",
    "file_layouts",
    "first_n_per_group",
    "genre_date_top_songs",
    "genre_dates",
    "genre_day",
    "in_file_layouts",
    "kpis_of_enriched",
    "latest_per_key",
    "profile_files",
    "read_keyed",
    "ready_catalogue",
    "route_files",
    "song_play_counts",
    "to_documents",
    "to_items",
    "top_genres_per_day",
    "top_k_per_group",
    "top_songs_per_genre",
    "upsert_by_key",
    "validate_files",
]
