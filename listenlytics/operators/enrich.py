"""Plays joined with the song catalogue."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import has_date, listen_date, to_long
from ..sources.catalogue import CATALOGUE_COLUMNS

BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64


def ready_catalogue(songs: DataFrame) -> DataFrame:
    """Catalogue rows that can count: a genre and a readable duration.

    Copies of a track are kept, each one multiplies the plays of the track.
    """
    return (
        songs.select(*CATALOGUE_COLUMNS)
        .withColumn("duration_ms", to_long(F.col("duration_ms")))
        .where(F.col("track_genre").isNotNull() & F.col("duration_ms").isNotNull())
        .where(F.col("track_id").isNotNull())
    )


def catalogue_fits(
    songs: DataFrame,
    limit: int = BROADCAST_BYTES,
    columns: Sequence[str] = CATALOGUE_COLUMNS,
) -> bool:
    """Measure the catalogue's ``columns``: are they small enough to send to every executor?"""
    texts = [c for c in columns if c != "duration_ms"]
    width = reduce(add, [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts])
    size = ready_catalogue(songs).agg(F.sum(width + _ROW_OVERHEAD).alias("bytes")).first()
    return (size.bytes or 0) <= limit


def sized(side: DataFrame, small: bool) -> DataFrame:
    """Broadcast a measured small side; otherwise leave the join to Spark and AQE."""
    return F.broadcast(side) if small else side


def is_dated(plays: DataFrame, formats: Sequence[str] = ()) -> Column:
    """Whether the listening time of a play can be read."""
    if "date" in plays.columns:
        return F.col("date").isNotNull()
    time = F.col("listen_time")
    if dict(plays.dtypes)["listen_time"] != "string":
        return time.isNotNull()
    return has_date(time, formats)


def dated_plays(plays: DataFrame, formats: Sequence[str] = ()) -> DataFrame:
    """Plays with a readable listening time, and its ``date`` (kept when already there)."""
    dated = plays.where(is_dated(plays, formats))
    if "date" in plays.columns:
        return dated
    time = F.col("listen_time")
    text = dict(plays.dtypes)["listen_time"] == "string"
    return dated.withColumn("date", listen_date(time, formats) if text else time.cast("date"))


def enrich(
    plays: DataFrame,
    songs: DataFrame,
    formats: Sequence[str] = (),
    small_catalogue: bool | None = None,
) -> DataFrame:
    """One row for each play and matching catalogue row, with the play's date.

    Plays of unknown tracks, with unreadable times, or of songs without a genre or
    duration are dropped. A catalogue above the broadcast limit is joined by a shuffle
    on track_id, where AQE splits the partition of a hot track.
    """
    if small_catalogue is None:
        small_catalogue = catalogue_fits(songs)
    return dated_plays(plays, formats).join(
        sized(ready_catalogue(songs), small_catalogue), "track_id", "inner"
    )
