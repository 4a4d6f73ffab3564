"""The three result tables of a play log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import catalogue_fits
from ..operators.kpis import (
    KPI_COLUMNS,
    TOP_GENRE_COLUMNS,
    TOP_SONG_COLUMNS,
    daily_genre_kpis,
    song_play_counts,
    top_genres_per_day,
    top_songs_per_genre,
)
from ..staging import side_by_side, written

# The tables with their unique keys.
KEYS = {
    "daily_genre_kpis": ("genre", "date"),
    "top_songs_per_genre": ("genre_date", "rank"),
    "top_genres_per_day": ("date", "rank"),
}
COLUMNS = {
    "daily_genre_kpis": KPI_COLUMNS,
    "top_songs_per_genre": TOP_SONG_COLUMNS,
    "top_genres_per_day": TOP_GENRE_COLUMNS,
}


def kpi_tables(
    plays: DataFrame,
    songs: DataFrame,
    by: Sequence[str] = (),
    formats: Sequence[str] = (),
    small_catalogue: bool | None = None,
) -> dict[str, DataFrame]:
    """The three result tables, with the columns ``by`` in front.

    Only the catalogue is measured here, unless ``small_catalogue`` says what it is.
    """
    if small_catalogue is None:
        small_catalogue = catalogue_fits(songs)
    kpis = daily_genre_kpis(plays, songs, by, formats, small_catalogue)
    counts = song_play_counts(plays, songs, by, formats, small_catalogue, ranked=True)
    return {
        "daily_genre_kpis": kpis,
        "top_songs_per_genre": top_songs_per_genre(counts, by=by),
        "top_genres_per_day": top_genres_per_day(kpis, by=by),
    }


def write_frames(
    plays: DataFrame,
    songs: DataFrame,
    prefix: str,
    by: Sequence[str] = (),
    formats: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Write the three tables below ``prefix``, replacing older ones; gives them as written.

    The genre ranking reads the KPIs just written, so the plays are scanned twice in
    all: once for the KPIs and once for the song counts.
    """
    prefix = prefix.rstrip("/")
    tables = kpi_tables(plays, songs, by, formats)
    frames: dict[str, DataFrame] = {}

    def write(name: str, table: DataFrame) -> None:
        frames[name] = written(table, f"{prefix}/{name}")

    def write_genres() -> None:
        write("daily_genre_kpis", tables["daily_genre_kpis"])
        write("top_genres_per_day", top_genres_per_day(frames["daily_genre_kpis"], by=by))

    def write_songs() -> None:
        write("top_songs_per_genre", tables["top_songs_per_genre"])

    side_by_side(plays.sparkSession, [write_genres, write_songs])
    return frames


def write_tables(
    plays: DataFrame,
    songs: DataFrame,
    prefix: str,
    by: Sequence[str] = (),
    formats: Sequence[str] = (),
) -> dict[str, str]:
    """``write_frames``, giving the paths of the three tables."""
    return {name: f"{prefix.rstrip('/')}/{name}" for name in write_frames(plays, songs, prefix, by, formats)}


def song_key_columns(top_songs: DataFrame) -> DataFrame:
    """Top songs with the genre and date of their ``genre_date`` as columns of their own.

    The table is partitioned by this date. The date is what follows the last ``#``, so a
    genre may hold that sign.
    """
    return top_songs.withColumns(
        {
            "genre": F.expr("left(genre_date, length(genre_date) - 11)"),
            "date": F.expr("cast(right(genre_date, 10) as date)"),
        }
    )
