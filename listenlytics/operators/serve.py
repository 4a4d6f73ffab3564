"""The four reads of the result tables.

The keyed tables are partitioned by date; every read that knows its day names it, so
that Spark opens this day's folder only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def genre_day(kpis: DataFrame, genre: str, date: str) -> DataFrame:
    """All KPIs of one genre on one day."""
    return kpis.where((F.col("genre") == genre) & (F.col("date") == F.lit(date).cast("date")))


def genre_date_top_songs(top_songs: DataFrame, genre_date: str) -> DataFrame:
    """The ranked songs under one ``genre#date`` key, best first."""
    found = top_songs.where(F.col("genre_date") == genre_date)
    if "date" in top_songs.columns:
        day = genre_date.rpartition("#")[2]
        found = found.where(F.col("date") == F.lit(day).try_cast("date"))
    return found.orderBy("rank")


def date_top_genres(top_genres: DataFrame, date: str) -> DataFrame:
    """The ranked genres of one day, best first."""
    return top_genres.where(F.col("date") == F.lit(date).cast("date")).orderBy("rank")


def genre_dates(kpis: DataFrame, genre: str) -> DataFrame:
    """The days on which a genre was played, with its listens."""
    return kpis.where(F.col("genre") == genre).select("date", "listen_count").orderBy("date")
