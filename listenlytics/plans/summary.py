"""What a run looked like, for the console."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.enrich import catalogue_fits, is_dated, ready_catalogue, sized
from ..operators.kpis import (
    daily_genre_kpis,
    song_play_counts,
    top_genres_per_day,
    top_songs_per_genre,
)


def row_counts(plays: DataFrame, songs: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """One row: plays, catalogue rows, enriched rows. Plays and catalogue copies are scanned once."""
    copies = ready_catalogue(songs).groupBy("track_id").agg(F.count("*").alias("copies"))
    small = catalogue_fits(songs, columns=("track_id",))
    matched = F.when(is_dated(plays, formats), F.col("copies"))
    counted = plays.join(sized(copies, small), "track_id", "left").agg(
        F.count("*").alias("streams_rows"),
        F.lit(0).cast("bigint").alias("songs_rows"),
        F.sum(matched).alias("enriched_rows"),
    )
    nothing = F.lit(0).cast("bigint")
    listed = songs.agg(
        nothing.alias("streams_rows"), F.count("*").alias("songs_rows"), nothing.alias("enriched_rows")
    )
    names = ("streams_rows", "songs_rows", "enriched_rows")
    return counted.unionAll(listed).agg(
        *[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names]
    )


def kpis_by_listen_count(kpis: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` genre days with the most listens."""
    return kpis.orderBy(F.desc("listen_count"), "genre", "date").limit(n)


def songs_in_order(top_songs: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` ranked songs by genre day and rank; songs of one rank by their name."""
    return top_songs.orderBy("genre_date", "rank", "track_name", "artists").limit(n)


def genres_in_order(top_genres: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` ranked genres by day and rank; genres of one rank by their name."""
    return top_genres.orderBy("date", "rank", "genre").limit(n)


def show_summary(plays: DataFrame, songs: DataFrame, formats: Sequence[str] = ()) -> None:
    """Print the row counts and the heads of the three tables; tied ranks are kept."""
    small = catalogue_fits(songs)
    kpis = daily_genre_kpis(plays, songs, (), formats, small)
    counts = song_play_counts(plays, songs, (), formats, small, ranked=True)
    row_counts(plays, songs, formats).show()
    kpis_by_listen_count(kpis).show(10, truncate=False)
    top_songs = top_songs_per_genre(counts, ties="keep").drop("track_id")
    songs_in_order(top_songs).show(15, truncate=40)
    genres_in_order(top_genres_per_day(kpis, ties="keep")).show(20, truncate=False)
