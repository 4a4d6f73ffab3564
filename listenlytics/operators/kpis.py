"""Daily KPIs, song counts and rankings.

None of these builds the enriched plays. Copies in the catalogue are folded into
weights, and song counts are taken before the join, so neither a hot track nor a track
with many catalogue copies multiplies rows.

``by`` adds leading group columns, for instance ``source_key`` for results per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import genre_date
from .enrich import catalogue_fits, dated_plays, ready_catalogue, sized
from .topk import top_k_per_group

# The columns of the results.
KPI_COLUMNS = (
    "genre",
    "date",
    "listen_count",
    "unique_listeners",
    "total_listening_time_ms",
    "avg_listening_time_per_user_ms",
)
SONG_COUNT_COLUMNS = ("track_genre", "date", "track_id", "track_name", "artists", "play_count")
TOP_SONG_COLUMNS = ("genre_date", "rank", "track_id", "track_name", "artists", "play_count")
TOP_GENRE_COLUMNS = ("date", "rank", "genre", "listen_count")


def _aggregate(plays: DataFrame, by: Sequence[str], weight: Column, time: Column) -> DataFrame:
    """KPIs of ``plays``, where one row stands for ``weight`` plays lasting ``time`` in all.

    Spark plans the exact distinct count in two levels, first by user, each with a
    map-side part: the rows of a hot genre are spread by user and arrive pre-added.
    """
    listens, listeners, total, per_user = KPI_COLUMNS[2:]
    return plays.groupBy(*by, F.col("track_genre").alias("genre"), "date").agg(
        F.sum(weight).alias(listens),
        F.count_distinct("user_id").alias(listeners),
        F.sum(time).alias(total),
    ).select("*", F.expr(f"{total} div nullif({listeners}, 0)").alias(per_user))


def kpis_of_enriched(enriched: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Daily genre KPIs of plays that already carry track_genre, date and duration_ms."""
    return _aggregate(enriched, by, F.lit(1).cast("bigint"), F.col("duration_ms"))


def genre_plays(
    plays: DataFrame,
    songs: DataFrame,
    formats: Sequence[str] = (),
    small_catalogue: bool | None = None,
) -> DataFrame:
    """One row for each play and genre of its track, with ``copies`` (matching catalogue
    rows) and ``copies_ms`` (their durations in total)."""
    if small_catalogue is None:
        small_catalogue = catalogue_fits(songs, columns=("track_id", "track_genre"))
    weights = (
        ready_catalogue(songs)
        .groupBy("track_id", "track_genre")
        .agg(F.count("*").alias("copies"), F.sum("duration_ms").alias("copies_ms"))
    )
    return dated_plays(plays, formats).join(sized(weights, small_catalogue), "track_id", "inner")


def daily_genre_kpis(
    plays: DataFrame,
    songs: DataFrame,
    by: Sequence[str] = (),
    formats: Sequence[str] = (),
    small_catalogue: bool | None = None,
) -> DataFrame:
    """Listens, exact unique listeners, listening time and time per listener by genre and day.

    Null users count as plays, not as listeners; the time per listener of a group that
    has only null users is null.
    """
    weighted = genre_plays(plays, songs, formats, small_catalogue)
    return _aggregate(weighted, by, F.col("copies"), F.col("copies_ms"))


def song_play_counts(
    plays: DataFrame,
    songs: DataFrame,
    by: Sequence[str] = (),
    formats: Sequence[str] = (),
    small_catalogue: bool | None = None,
    ranked: bool = False,
) -> DataFrame:
    """Plays of each song by genre and day.

    Plays are counted by track and day first, so only those counts meet the catalogue;
    both sides are then unique and the product of the counts needs no further grouping.

    ``ranked``: the counts will be sorted, so other tasks get them first. Else those that add
    them up, into which AQE merges many partitions, would also hold them sorted and with
    their titles.
    """
    if small_catalogue is None:
        small_catalogue = catalogue_fits(songs)
    played = (
        dated_plays(plays, formats)
        .where(F.col("track_id").isNotNull())
        .groupBy(*by, "track_id", "date")
        .agg(F.count("*").alias("plays"))
    )
    if ranked:
        # in another order than the sums' keys, or Spark leaves this shuffle out
        played = played.repartition("date", "track_id", *by)
    titles = (
        ready_catalogue(songs)
        .groupBy("track_id", "track_genre", "track_name", "artists")
        .agg(F.count("*").alias("copies"))
    )
    return (
        played.join(sized(titles, small_catalogue), "track_id", "inner")
        .withColumn("play_count", F.col("plays") * F.col("copies"))
        .select(*by, *SONG_COUNT_COLUMNS)
    )


def top_songs_per_genre(
    counts: DataFrame, k: int = 3, ties: str = "break", by: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` most played songs of each genre and day out of ``song_play_counts``.

    ``ties='break'`` prefers the higher track_id; ``ties='keep'`` lets equal counts share
    a rank, so more than ``k`` songs can come out.
    """
    order = ["play_count", "track_id"] if ties == "break" else ["play_count"]
    ranked = top_k_per_group(counts, [*by, "track_genre", "date"], order, k, ties)
    key = genre_date(F.col("track_genre"), F.col("date")).alias("genre_date")
    return ranked.withColumn("genre_date", key).select(*by, *TOP_SONG_COLUMNS)


def top_genres_per_day(
    kpis: DataFrame, k: int = 5, ties: str = "break", by: Sequence[str] = ()
) -> DataFrame:
    """The ``k`` most played genres of each day out of ``daily_genre_kpis``."""
    order = ["listen_count", "genre"] if ties == "break" else ["listen_count"]
    ranked = top_k_per_group(kpis, [*by, "date"], order, k, ties)
    return ranked.select(*by, *TOP_GENRE_COLUMNS)
