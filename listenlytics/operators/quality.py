"""Quality check of play files: one profile of all files, one verdict for each.

The profile is a single grouped aggregate over numbers, which Spark hashes and adds up
in the scan tasks, so a file that holds most of the rows is counted where its rows are.
Only files that the profile makes suspect are looked at a second time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import NULL_TOKENS, null_if_token, percent_text, time_is_bad
from ..session import new_work_folder
from ..sources.plays import LANDED_ORDER, PLAY_COLUMNS, READ_ORDER
from ..staging import written
from .topk import first_n_per_group

# The limits of the check.
MIN_ROWS = 1
MAX_NULL_RATE = 0.05


def _null_rate(column: str) -> Column:
    return (F.count("*") - F.count(column)).cast("double") / F.count("*")


def _checked(plays: DataFrame, null_tokens: Sequence[str]) -> DataFrame:
    """Null tokens become nulls in the text columns under check."""
    types = dict(plays.dtypes)
    texts = [c for c in PLAY_COLUMNS if types[c] == "string"]
    return plays.withColumns({c: null_if_token(F.col(c), null_tokens) for c in texts})


def _profile(
    checked: DataFrame, statistics: Sequence[Column], formats: Sequence[str], work: str | None = None
) -> DataFrame:
    """One row of statistics for each file, written as a small table for the later steps."""
    profile = checked.groupBy("source_key").agg(
        F.count("*").alias("row_count"),
        _null_rate("user_id").alias("user_id_null_rate"),
        _null_rate("track_id").alias("track_id_null_rate"),
        F.count("listen_time").alias("listen_time_non_null"),
        F.count_if(time_is_bad(F.col("listen_time"), formats)).alias("listen_time_bad"),
        *statistics,
    )
    return written(profile, work or new_work_folder(checked.sparkSession, "profile"))


def _bad_times_in_sample(
    checked: DataFrame,
    profile: DataFrame,
    order: Sequence[str] | None,
    sample_rows: int,
    formats: Sequence[str],
) -> DataFrame:
    """``profile`` with listen_time_bad counted in the first ``sample_rows`` non-null times.

    The rows are in ``order``; without it, in that of their ``row`` or of the landed table.
    A file without bad times has none in its sample, and a file that is no longer than
    the sample keeps its count, so only the other files are put in order.
    """
    longer = F.col("listen_time_non_null") > sample_rows
    suspects = profile.where((F.col("listen_time_bad") > 0) & longer).select("source_key")
    if suspects.isEmpty():
        return profile
    order = order or (READ_ORDER if "row" in checked.columns else LANDED_ORDER)
    places = [f"order_{i}" for i in range(len(order))]
    timed = checked.where(F.col("listen_time").isNotNull()).select(
        "source_key",
        "listen_time",
        *[F.col(column).alias(place) for column, place in zip(order, places, strict=True)],
    )
    sample = first_n_per_group(
        timed.join(suspects, "source_key", "left_semi"), ["source_key"], places, sample_rows
    )
    counted = sample.groupBy("source_key").agg(
        F.count_if(time_is_bad(F.col("listen_time"), formats)).alias("sample_bad")
    )
    return (
        profile.join(counted, "source_key", "left")
        .withColumn("listen_time_bad", F.coalesce("sample_bad", "listen_time_bad"))
        .drop("sample_bad")
    )


def profile_files(
    plays: DataFrame,
    order: Sequence[str] | None = None,
    sample_rows: int | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    formats: Sequence[str] = (),
) -> DataFrame:
    """Statistics of each file: rows, null rates, times present, bad times, distinct tracks.

    Bad times are counted in the whole file; with ``sample_rows`` only among the first
    that many non-null times, in the ``order`` of the rows.
    """
    checked = _checked(plays, null_tokens)
    distinct = F.count_distinct("track_id").alias("track_id_distinct")
    profile = _profile(checked, [distinct], formats)
    if sample_rows is None:
        return profile
    return _bad_times_in_sample(checked, profile, order, sample_rows, formats)


def _single_tracks(checked: DataFrame, profile: DataFrame) -> DataFrame:
    """``profile`` with the only track of a file in ``single_track``, null for other files.

    Equal hash bounds make a file suspect; its distinct tracks then decide.
    """
    suspects = profile.where(F.col("low_hash") == F.col("high_hash")).select("source_key")
    if suspects.isEmpty():
        return profile.withColumn("single_track", F.lit(None).cast("string"))
    tracks = (
        checked.where(F.col("track_id").isNotNull())
        .join(suspects, "source_key", "left_semi")
        .select("source_key", F.col("track_id").cast("string").alias("track_id"))
        .distinct()
        .groupBy("source_key")
        .agg(F.count("*").alias("tracks"), F.min("track_id").alias("single_track"))
        .where(F.col("tracks") == 1)
        .drop("tracks")
    )
    return profile.join(tracks, "source_key", "left")


def _with_files(profile: DataFrame, files: DataFrame, inspection: DataFrame) -> DataFrame:
    """All arrived files with what was found in them and in their rows."""
    found = inspection.groupBy("source_key").agg(
        F.sum("line_count").alias("line_count"),
        F.sum("invalid_lines").alias("invalid_lines"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("missing")))).alias("missing"),
    )
    return (
        files.select("source_key")
        .distinct()
        .join(found, "source_key", "left")
        .join(profile, "source_key", "left")
        .withColumn("row_count", F.coalesce("row_count", "line_count"))
    )


def _reason(max_null_rate: float, min_rows: int) -> Column:
    """The first rule that a file breaks, as text; empty when it breaks none."""

    # The texts of the reasons.
    def could_not_read(problem: str) -> Column:
        return F.lit(f"Could not read file: {problem}")

    def too_many_nulls(column: str) -> tuple[Column, Column]:
        rate = F.col(f"{column}_null_rate")
        text = F.concat(
            F.lit(f"Column '{column}' has "),
            percent_text(rate),
            F.lit(f" null values (threshold {max_null_rate:.0%})"),
        )
        return rate > max_null_rate, text

    missing = F.transform("missing", lambda c: F.concat(F.lit("'"), c, F.lit("'")))
    rules = [
        (F.col("line_count").isNull(), could_not_read("No columns to parse from file")),
        (F.col("invalid_lines") > 0, could_not_read("not valid UTF-8")),
        (F.col("unreadable"), could_not_read("a quoted field is not closed")),
        (F.col("overlong"), could_not_read("a row has more fields than the header")),
        (
            F.col("row_count") < min_rows,
            F.format_string(f"File contains %d rows — must have at least {min_rows}", "row_count"),
        ),
        (
            F.array_size("missing") > 0,
            F.concat(F.lit("Missing required columns: ["), F.array_join(missing, ", "), F.lit("]")),
        ),
        too_many_nulls("user_id"),
        too_many_nulls("track_id"),
        (
            F.col("listen_time_non_null") == 0,
            F.lit("Column 'listen_time' has no non-null values to parse"),
        ),
        (
            F.col("listen_time_bad") > 0,
            F.lit("Column 'listen_time' is not parseable as timestamps"),
        ),
        (
            F.col("single_track").isNotNull(),
            F.concat(
                F.lit("Column 'track_id' contains only a single distinct value ('"),
                F.col("single_track"),
                F.lit("') — likely corrupt file"),
            ),
        ),
    ]
    return F.coalesce(*[F.when(broken, text) for broken, text in rules], F.lit(""))


def validate_files(
    plays: DataFrame,
    files: DataFrame | None = None,
    inspection: DataFrame | None = None,
    order: Sequence[str] | None = None,
    sample_rows: int | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    max_null_rate: float = MAX_NULL_RATE,
    min_rows: int = MIN_ROWS,
    formats: Sequence[str] = (),
    work: str | None = None,
) -> DataFrame:
    """PASSED or FAILED with the first reason that applies, one row for each ``source_key``.

    All times are checked; ``sample_rows`` limits that to the first of each file, in the
    ``order`` of its rows. ``plays`` alone is enough for rows that are already tables. For files, ``files``
    (source_key) names all that arrived and ``inspection`` what ``inspect_files`` found;
    this adds the verdicts on files that give no rows or lack columns. A small profile table
    is written at once, to ``work`` or a new folder of the shared work space, and read by the frame.
    """
    checked = _checked(plays, null_tokens)
    track_hash = F.when(F.col("track_id").isNotNull(), F.xxhash64("track_id"))
    marks = [
        F.bool_or(mark if mark in plays.columns else F.lit(False)).alias(mark)
        for mark in ("unreadable", "overlong")
    ]
    statistics = [
        F.min(track_hash).alias("low_hash"),
        F.max(track_hash).alias("high_hash"),
        *marks,
    ]
    profile = _profile(checked, statistics, formats, work)
    if sample_rows is not None:
        profile = _bad_times_in_sample(checked, profile, order, sample_rows, formats)
    profile = _single_tracks(checked, profile)
    if files is not None and inspection is not None:
        profile = _with_files(profile, files, inspection)
    else:
        profile = profile.withColumns(
            {
                "line_count": F.col("row_count"),
                "invalid_lines": F.lit(0),
                "missing": F.array().cast("array<string>"),
            }
        )
    return (
        profile.withColumn("reason", _reason(max_null_rate, min_rows))
        .withColumn("status", F.when(F.col("reason") == "", "PASSED").otherwise("FAILED"))
        .select("source_key", "status", "reason")
    )
