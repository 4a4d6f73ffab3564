"""The operators at work on the star-schema test tables, one callable for each query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import to_long
from .operators import (
    daily_genre_kpis,
    date_top_genres,
    enrich,
    genre_date_top_songs,
    genre_dates,
    genre_day,
    in_file_layouts,
    kpis_of_enriched,
    profile_files,
    read_keyed,
    route_files,
    song_play_counts,
    to_documents,
    to_items,
    top_genres_per_day,
    top_songs_per_genre,
    upsert_by_key,
    validate_files,
)
from .files import list_arrivals, list_files, move, touch
from .operators.routing import INBOX
from .plans import (
    genres_in_order,
    kpis_by_listen_count,
    read_verdicts,
    row_counts,
    run_inbox,
    song_key_columns,
    songs_in_order,
    table_paths,
)
from .session import new_work_folder
from .sources import inspect_files, land_plays, read_catalogue, read_parts, read_plays
from .sources.tables import (
    defective_files,
    event_plays,
    order_plays,
    part_catalogue,
    table,
    yearly_files,
)
from .streaming import run_stream, stream_into_table

Query = Callable[[SparkSession, str], DataFrame]

ENRICHED = (
    "event_id",
    "user_id",
    "track_id",
    "listen_time",
    "track_genre",
    "duration_ms",
    "track_name",
    "artists",
    "date",
)
GENRE, DAY = "ECONOMY", "2024-01-15"


def _plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_plays(table(spark, sf_dir, "events"))


def _kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_genre_kpis(_plays(spark, sf_dir), part_catalogue(spark, sf_dir))


def _counts(spark: SparkSession, sf_dir: str, ranked: bool = False) -> DataFrame:
    return song_play_counts(_plays(spark, sf_dir), part_catalogue(spark, sf_dir), ranked=ranked)


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defective_files(table(spark, sf_dir, "events"))


# Enrichment and KPIs


def enrich_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich(_plays(spark, sf_dir), part_catalogue(spark, sf_dir)).select(*ENRICHED)


def top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_songs_per_genre(_counts(spark, sf_dir, ranked=True))


def top_songs_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_songs_per_genre(_counts(spark, sf_dir, ranked=True), ties="keep").drop("track_id")


def top_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_genres_per_day(_kpis(spark, sf_dir))


def top_genres_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_genres_per_day(_kpis(spark, sf_dir), ties="keep")


def star_daily_genre_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_genre_kpis(order_plays(spark, sf_dir), part_catalogue(spark, sf_dir))


def star_song_play_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return song_play_counts(order_plays(spark, sf_dir), part_catalogue(spark, sf_dir))


def _star_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return song_play_counts(order_plays(spark, sf_dir), part_catalogue(spark, sf_dir), ranked=True)


def star_top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_songs_per_genre(_star_counts(spark, sf_dir))


def star_top_songs_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_songs_per_genre(_star_counts(spark, sf_dir), ties="keep").drop("track_id")


def star_top_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_genres_per_day(star_daily_genre_kpis(spark, sf_dir))


def kpis_null_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days and types as genres, where the users of one type are all unknown."""
    unknown = (F.col("event_type") == "view") | (F.col("event_id") % 20 == 0)
    enriched = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("track_genre"),
        F.col("ts").cast("date").alias("date"),
        F.when(~unknown, F.col("user_id")).alias("user_id"),
        F.round(F.col("value") * 1000).cast("bigint").alias("duration_ms"),
    )
    return kpis_of_enriched(enriched)


def _written_duration(key: str, size: str) -> Column:
    """A number as text in several spellings, some of them no number."""
    text, kind = F.col(key).cast("string"), F.col(size) % 7
    return (
        F.when(kind == 0, "oops")
        .when(kind == 1, F.concat(text, F.lit(".0")))
        .when(kind == 2, F.concat(text, F.lit(".75")))
        .when(kind == 3, (F.col(key) + F.lit(9007199254740993)).cast("string"))
        .when(kind == 4, F.concat(F.lit(" "), text, F.lit(" ")))
        .otherwise(text)
    )


def duration_try_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = to_long(_written_duration("p_partkey", "p_size"))
    return (
        table(spark, sf_dir, "part")
        .select(F.col("p_type").alias("track_genre"), ms.alias("ms"))
        .groupBy("track_genre")
        .agg(
            F.count("*").alias("n_songs"),
            F.count("ms").alias("n_parsed"),
            F.sum(F.col("ms") % 1000003).alias("total_rest"),
            F.max("ms").alias("longest_ms"),
        )
    )


# Reads of the stored result tables


def _stored(spark: SparkSession, name: str, rows: DataFrame, keys: list[str]) -> DataFrame:
    target = new_work_folder(spark, name)
    upsert_by_key(target, rows, keys)
    return read_keyed(spark, target)


def _stored_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, "daily_genre_kpis", _kpis(spark, sf_dir), ["genre", "date"])


def genre_day_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_day(_stored_kpis(spark, sf_dir), GENRE, DAY)


def genre_date_top_songs_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = song_key_columns(top_songs(spark, sf_dir))
    stored = _stored(spark, "top_songs_per_genre", rows, ["genre_date", "rank"])
    return genre_date_top_songs(stored, f"{GENRE}#{DAY}").drop("genre", "date")


def date_top_genres_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = top_genres(spark, sf_dir)
    return date_top_genres(_stored(spark, "top_genres_per_day", rows, ["date", "rank"]), DAY)


def genre_dates_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genre_dates(_stored_kpis(spark, sf_dir), GENRE)


# Reports


def first_top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return songs_in_order(top_songs_ties(spark, sf_dir))


def first_top_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genres_in_order(top_genres_ties(spark, sf_dir))


def most_listened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis_by_listen_count(_kpis(spark, sf_dir))


def run_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_counts(_plays(spark, sf_dir), part_catalogue(spark, sf_dir))


# Sinks


def _two_exports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The play log as two overlapping files: until noon of the 20th, from 6:00 of the 15th."""
    plays = _plays(spark, sf_dir)
    first = plays.where(F.col("listen_time") < F.lit("2024-01-20 12:00:00").cast("timestamp_ntz"))
    second = plays.where(F.col("listen_time") >= F.lit("2024-01-15 06:00:00").cast("timestamp_ntz"))
    return first, second


def upsert_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_work_folder(spark, "daily_genre_kpis")
    songs = part_catalogue(spark, sf_dir)
    for plays in _two_exports(spark, sf_dir):
        upsert_by_key(target, daily_genre_kpis(plays, songs), ["genre", "date"])
    return read_keyed(spark, target)


def _upsert_rankings(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """The second export meets a catalogue without three genres, so it has fewer ranks."""
    target = new_work_folder(spark, "top_genres_per_day")
    songs = part_catalogue(spark, sf_dir)
    fewer = songs.where(~F.col("track_genre").isin("ECONOMY", "LARGE", "SMALL"))
    for plays, catalogue in zip(_two_exports(spark, sf_dir), (songs, fewer), strict=True):
        rows = top_genres_per_day(daily_genre_kpis(plays, catalogue))
        upsert_by_key(target, rows, ["date", "rank"], mode=mode)
    return read_keyed(spark, target)


def upsert_top_genres_stale_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_rankings(spark, sf_dir, "replace")


def upsert_top_genres_whole_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_rankings(spark, sf_dir, "replace_group")


def kpi_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_items(_kpis(spark, sf_dir))


def kpi_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_documents(kpis_null_users(spark, sf_dir))


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.when(F.col("event_id") % 100 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    items = to_items(table(spark, sf_dir, "events").select("event_id", "ts", value.alias("value")))
    return items.withColumn("value", F.col("value").cast("double"))


def union_part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and other events as parts with different columns, read back as one table."""
    folder = new_work_folder(spark, "parts")
    events = table(spark, sf_dir, "events")
    clicks = F.col("event_type") == "click"
    events.where(clicks).select("event_id", "user_id").write.parquet(f"{folder}/clicks")
    events.where(~clicks).select("event_id", "event_type").write.parquet(f"{folder}/others")
    return read_parts(spark, folder).select("event_id", "user_id", "event_type")


def union_parts_of_other_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of the event log that hold the same columns as int, bigint, double, and as text."""
    folder = new_work_folder(spark, "parts")
    events = table(spark, sf_dir, "events")
    kinds = {"click": ("int", "bigint"), "view": ("bigint", "string"), "purchase": ("double", "int")}
    rest = events.where(~F.col("event_type").isin(list(kinds)))
    rest.select("event_id").write.parquet(f"{folder}/rest")
    for kind, (number, user) in kinds.items():
        part = events.where(F.col("event_type") == kind)
        part.select(F.col("event_id").cast(number), F.col("user_id").cast(user)).write.parquet(f"{folder}/{kind}")
    return read_parts(spark, folder).select("event_id", "user_id")


# Quality of files


def file_quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_files(_files(spark, sf_dir))


def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_files(_files(spark, sf_dir))


def validate_all_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long files, one of which has its first bad time behind the first thousand."""
    return validate_files(yearly_files(spark, sf_dir))


def validate_first_1000(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, where only the first thousand times of each count."""
    return validate_files(yearly_files(spark, sf_dir), order=["event_id"], sample_rows=1000)


def route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_files(validate(spark, sf_dir))


def passed_files_daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = _files(spark, sf_dir)
    passed = validate(spark, sf_dir).where("status = 'PASSED'")
    good = plays.join(passed, "source_key", "left_semi")
    return daily_genre_kpis(good, part_catalogue(spark, sf_dir)).select(
        "genre", "date", "listen_count", "unique_listeners"
    )


# CSV files and whole runs


def _catalogue_csv(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    path = f"{root}/raw/songs"
    songs = part_catalogue(spark, sf_dir)
    songs.write.option("header", True).option("escape", '"').csv(path)
    return read_catalogue(spark, path)


def _daily_folders(spark: SparkSession, sf_dir: str, root: str) -> list[str]:
    """The defective files as CSV, one folder of part files for each day."""
    day = F.regexp_extract("source_key", "([0-9-]+)[.]csv$", 1)
    rows = _files(spark, sf_dir).withColumn("day", day).drop("source_key")
    inbox = f"{root}/{INBOX}"
    rows.write.partitionBy("day").option("header", True).csv(inbox)
    return [path for path, _ in list_files(spark, inbox)]


def csv_enrich_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_work_folder(spark, "csv")
    songs = _catalogue_csv(spark, sf_dir, root)
    log = _plays(spark, sf_dir).withColumn("listen_time", F.col("listen_time").cast("string"))
    log.write.option("header", True).csv(f"{root}/{INBOX}")
    files = [path for path, _ in list_files(spark, f"{root}/{INBOX}")]
    plays = read_plays(spark, inspect_files(spark, files, root), root, keep=["event_id"])
    return enrich(plays, songs).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "track_id",
        F.col("listen_time").cast("timestamp_ntz").alias("listen_time"),
        *ENRICHED[4:],
    )


def csv_daily_genre_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_work_folder(spark, "csv")
    songs = _catalogue_csv(spark, sf_dir, root)
    log = _plays(spark, sf_dir).withColumn("listen_time", F.col("listen_time").cast("string"))
    log.write.option("header", True).csv(f"{root}/{INBOX}")
    files = [path for path, _ in list_files(spark, f"{root}/{INBOX}")]
    plays = read_plays(spark, inspect_files(spark, files, root), root)
    return daily_genre_kpis(plays, songs)


def csv_kpis_decimal_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as CSV whose durations are written with and without fractions."""
    root = new_work_folder(spark, "csv")
    tail = F.when(F.col("duration_ms") % 3 == 0, ".0").when(F.col("duration_ms") % 3 == 1, ".5").otherwise("")
    songs = part_catalogue(spark, sf_dir).withColumn(
        "duration_ms", F.concat(F.col("duration_ms").cast("string"), tail)
    )
    songs.write.option("header", True).option("escape", '"').csv(f"{root}/songs")
    return daily_genre_kpis(_plays(spark, sf_dir), read_catalogue(spark, f"{root}/songs"))


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV file for each event type, whose notes hold line breaks, blank lines, commas and quotes."""
    root = new_work_folder(spark, "csv")
    text = [F.col(c).cast("string").alias(c) for c in ("user_id", "track_id", "listen_time")]
    ends = F.when(F.col("event_id") % 3 == 0, "\n\n,\"").when(F.col("event_id") % 3 == 1, "\n").otherwise(";")
    note = F.concat("event_type", ends, "props", ends, F.col("event_id").cast("string"))
    log = event_plays(table(spark, sf_dir, "events"), "event_type", "props")
    rows = log.select("event_type", "event_id", note.alias("note"), *text).repartition("event_type")
    writer = rows.write.partitionBy("event_type").option("header", True).option("escape", '"')
    writer.csv(f"{root}/{INBOX}")
    paths = [path for path, _ in list_files(spark, f"{root}/{INBOX}")]
    plays = read_plays(spark, inspect_files(spark, paths, root), root, keep=["event_id", "note"])
    return plays.select(
        F.col("event_id").cast("bigint").alias("event_id"),
        F.col("user_id").cast("bigint").alias("user_id"),
        "track_id",
        F.col("listen_time").cast("timestamp_ntz").alias("listen_time"),
        "note",
    )


def csv_file_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder of CSV files for each event type, with differing headers and widths.

    Clicks lack the time, purchases have a field too many in some rows, errors have
    another column order, sign-ups other letter cases. Of the views there are three further
    folders, with a header only, without times, and not in UTF-8, and one holds an empty file.
    """
    root = new_work_folder(spark, "csv")
    text = {c: F.col(c).cast("string").alias(c) for c in ("user_id", "track_id", "listen_time")}
    log = event_plays(table(spark, sf_dir, "events"), "event_type")
    longer = F.when(F.col("event_id") % 2 == 0, F.concat(text["listen_time"], F.lit(",late")))
    layouts = {
        "click": ["user_id", "track_id"],
        "purchase": [
            "user_id",
            "track_id",
            F.coalesce(longer, text["listen_time"]).alias("listen_time"),
        ],
        "error": [text["listen_time"], "user_id", "track_id", "event_id"],
        "signup": [text[c].alias(c.upper()) for c in text],
        "view": [*text.values()],
    }
    for kind, columns in layouts.items():
        rows = log.where(F.col("event_type") == kind).select(*columns)
        writer = rows.write.option("header", True).option("quote", "\u0000")
        writer.csv(f"{root}/{INBOX}/type={kind}")
    views = log.where(F.col("event_type") == "view")
    untimed = F.lit(None).cast("string").alias("listen_time")
    foreign = F.concat(text["user_id"], F.lit("\u00e9")).alias("user_id")
    others = {
        "header_only": (views.select(*text.values()).limit(0).coalesce(1), "UTF-8"),
        "untimed": (views.select("user_id", "track_id", untimed), "UTF-8"),
        "latin": (views.select(foreign, "track_id", text["listen_time"]), "ISO-8859-1"),
    }
    for kind, (rows, encoding) in others.items():
        writer = rows.write.option("header", True).option("encoding", encoding)
        writer.csv(f"{root}/{INBOX}/type={kind}")
    touch(spark, f"{root}/{INBOX}/type=empty/part-0.csv")
    paths = [path for path, _ in list_files(spark, f"{root}/{INBOX}")]
    inspection = inspect_files(spark, paths, root, "directory")
    plays = land_plays(spark, inspection, root, f"{root}/plays", "directory")
    kinds = [(f"{INBOX}/type={kind}",) for kind in [*layouts, *others, "empty"]]
    folders = spark.createDataFrame(kinds, "source_key string")
    return validate_files(plays, folders, inspection)


def csv_time_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays of each day in one folder of CSV files for each event type, each with a time layout of its own.

    Of the views some times are in the standard form and some not; of the errors some cannot be read.
    """
    root = new_work_folder(spark, "csv")
    log = event_plays(table(spark, sf_dir, "events"), "event_type")
    kind, event, standard = F.col("event_type"), F.col("event_id"), F.col("listen_time").cast("string")
    layouts = {"click": "M/d/yyyy H:mm:ss", "purchase": "d/M/yyyy HH:mm", "signup": "MMM d, yyyy H:mm"}
    time = F.when((kind == "error") & (event % 10 == 0), "not-a-time")
    time = time.when(kind == "error", F.date_format("listen_time", "d.M.yyyy HH:mm:ss"))
    time = time.when((kind == "view") & (event % 10 == 0), F.date_format("listen_time", "yyyy/M/d"))
    for name, layout in layouts.items():
        time = time.when(kind == name, F.date_format("listen_time", layout))
    rows = log.select(kind.alias("type"), "user_id", "track_id", time.otherwise(standard).alias("listen_time"))
    rows.write.partitionBy("type").option("header", True).csv(f"{root}/{INBOX}")
    paths = [path for path, _ in list_files(spark, f"{root}/{INBOX}")]
    inspection = inspect_files(spark, paths, root, "directory")
    landed = land_plays(spark, inspection, root, f"{root}/plays", "directory")
    plays = in_file_layouts(landed, f"{root}/layouts")
    days = plays.groupBy("source_key", "date").agg(F.count("*").alias("plays"))
    return days.join(validate_files(plays), "source_key")


def _run(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, str]]:
    root = new_work_folder(spark, "run")
    songs = _catalogue_csv(spark, sf_dir, root)
    _daily_folders(spark, sf_dir, root)
    return root, run_inbox(spark, songs, root, "first", unit="directory")


def run_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _run(spark, sf_dir)
    key = F.regexp_replace("source_key", "day=(.*)$", "$1.csv")
    return read_verdicts(spark, root, "first").select(
        key.alias("source_key"), "status", "reason"
    )


def run_daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _run(spark, sf_dir)
    return read_keyed(
        spark, tables["daily_genre_kpis"], "genre string, date date, listen_count bigint, "
        "unique_listeners bigint, total_listening_time_ms bigint, "
        "avg_listening_time_per_user_ms bigint"
    )


def run_top_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _run(spark, sf_dir)
    return read_keyed(
        spark, tables["top_songs_per_genre"], "genre_date string, rank int, track_id string, "
        "track_name string, artists string, play_count bigint"
    ).select("genre_date", "rank", "track_id", "track_name", "artists", "play_count")


def run_top_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _run(spark, sf_dir)
    return read_keyed(
        spark, tables["top_genres_per_day"], "date date, rank int, genre string, listen_count bigint"
    )


def run_result_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdicts as they lie at their result keys, one object for each file."""
    root, _ = _run(spark, sf_dir)
    objects = spark.read.schema("source_key string, status string, reason string, result_key string")
    key = F.regexp_replace("source_key", "day=(.*)$", "$1.csv")
    place = F.regexp_replace("result_key", "day=([0-9-]*)", "$1.csv")
    return objects.json(f"{root}/tmp/validation/{INBOX}/*.result.json").select(
        key.alias("source_key"), "status", "reason", place.alias("result_key")
    )


def _send(spark: SparkSession, rows: DataFrame, root: str) -> None:
    """Put plays into the inbox, one CSV file for each value of ``file``, named after it."""
    folder = new_work_folder(spark, "outbox")
    plays = rows.select("file", "user_id", "track_id", F.col("listen_time").cast("string").alias("listen_time"))
    plays.repartition("file").write.partitionBy("file").option("header", True).csv(folder)
    for sent in list_arrivals(spark, folder):
        name = sent.path.rpartition("/")[0].rpartition("file=")[2]
        move(spark, sent, f"{root}/{INBOX}/{name}.csv")


def _by_day(plays: DataFrame) -> DataFrame:
    return plays.withColumn("file", F.col("listen_time").cast("date").cast("string"))


def run_replace_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later file with few plays of the second half of the month replaces whole days."""
    root = new_work_folder(spark, "run")
    plays = _plays(spark, sf_dir)
    day = F.dayofmonth("listen_time")
    _send(spark, plays.where(day <= 20).withColumn("file", F.lit("first")), root)
    later = plays.where((day >= 15) & (F.col("event_id") % 40 == 0))
    _send(spark, later.withColumn("file", F.lit("second")), root)
    run_inbox(spark, part_catalogue(spark, sf_dir), root, "both", mode="replace_group")
    return read_keyed(
        spark, table_paths(root)["top_genres_per_day"], "date date, rank int, genre string, listen_count bigint"
    )


def run_duplicate_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts where the catalogue has one track under two names: only files it ranks in fail."""
    root = new_work_folder(spark, "run")
    songs = part_catalogue(spark, sf_dir)
    again = songs.where("track_id = '7'").withColumn("track_name", F.concat("track_name", F.lit(" (live)")))
    _send(spark, _by_day(_plays(spark, sf_dir)), root)
    run_inbox(spark, songs.unionByName(again), root, "twice")
    return read_verdicts(spark, root, "twice").select("source_key", "status", "reason")


# Streams


def stream_daily_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_work_folder(spark, "stream")
    target = f"{folder}/daily_genre_kpis"
    songs = part_catalogue(spark, sf_dir)
    events = (
        spark.readStream.schema(table(spark, sf_dir, "events").schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )

    def kpis(plays: DataFrame) -> DataFrame:
        return daily_genre_kpis(plays, songs)

    query = stream_into_table(
        event_plays(events), kpis, target, ["genre", "date"], f"{folder}/checkpoint"
    )
    query.awaitTermination()
    return read_keyed(spark, target)


def stream_passed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_work_folder(spark, "arrivals")
    songs = _catalogue_csv(spark, sf_dir, root)
    _daily_folders(spark, sf_dir, root)
    query = run_stream(
        spark,
        lambda: songs,
        root,
        f"{root}/checkpoint",
        max_files_per_trigger=None,
        unit="directory",
    )
    query.awaitTermination()
    return read_keyed(
        spark, f"{root}/tables/daily_genre_kpis",
        "genre string, date date, listen_count bigint, unique_listeners bigint",
    ).select("genre", "date", "listen_count", "unique_listeners")


def stream_resent_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day files, some of which are sent again under their names with other rows."""
    root = new_work_folder(spark, "arrivals")
    songs = part_catalogue(spark, sf_dir)
    plays = _by_day(_plays(spark, sf_dir))
    again = plays.where(F.dayofmonth("listen_time").between(10, 15) & (F.col("event_id") % 2 == 0))
    for sent in (plays, again):
        _send(spark, sent, root)
        run_stream(
            spark, lambda: songs, root, f"{root}/checkpoint", max_files_per_trigger=None
        ).awaitTermination()
    return read_keyed(
        spark, table_paths(root)["daily_genre_kpis"],
        "genre string, date date, listen_count bigint, unique_listeners bigint",
    ).select("genre", "date", "listen_count", "unique_listeners")


QUERIES: dict[str, Query] = {
    "enrich_streams": enrich_streams,
    "daily_genre_kpis": _kpis,
    "song_play_counts": _counts,
    "top_songs_per_genre": top_songs,
    "top_songs_per_genre_ties": top_songs_ties,
    "top_genres_per_day": top_genres,
    "top_genres_per_day_ties": top_genres_ties,
    "star_daily_genre_kpis": star_daily_genre_kpis,
    "star_song_play_counts": star_song_play_counts,
    "star_top_songs_per_genre": star_top_songs,
    "star_top_songs_per_genre_ties": star_top_songs_ties,
    "star_top_genres_per_day": star_top_genres,
    "kpis_null_users": kpis_null_users,
    "duration_try_cast": duration_try_cast,
    "genre_day_lookup": genre_day_lookup,
    "genre_date_top_songs_lookup": genre_date_top_songs_lookup,
    "date_top_genres_lookup": date_top_genres_lookup,
    "genre_dates_lookup": genre_dates_lookup,
    "kpis_by_listen_count": most_listened,
    "first_top_songs": first_top_songs,
    "first_top_genres": first_top_genres,
    "run_row_counts": run_row_counts,
    "upsert_kpis": upsert_kpis,
    "upsert_top_genres_stale_ranks": upsert_top_genres_stale_ranks,
    "upsert_top_genres_whole_days": upsert_top_genres_whole_days,
    "kpi_items": kpi_items,
    "kpi_documents": kpi_documents,
    "event_items": event_items,
    "union_part_files": union_part_files,
    "union_parts_of_other_types": union_parts_of_other_types,
    "file_quality_profile": file_quality_profile,
    "validate_files": validate,
    "validate_files_all_times": validate_all_times,
    "validate_files_first_1000": validate_first_1000,
    "route_files": route,
    "passed_files_daily_kpis": passed_files_daily_kpis,
    "csv_enrich_streams": csv_enrich_streams,
    "csv_daily_genre_kpis": csv_daily_genre_kpis,
    "csv_kpis_decimal_durations": csv_kpis_decimal_durations,
    "csv_line_breaks": csv_line_breaks,
    "csv_time_layouts": csv_time_layouts,
    "csv_file_verdicts": csv_file_verdicts,
    "run_verdicts": run_verdicts,
    "run_daily_genre_kpis": run_daily_kpis,
    "run_top_songs_per_genre": run_top_songs,
    "run_top_genres_per_day": run_top_genres,
    "run_result_objects": run_result_objects,
    "run_replace_group": run_replace_group,
    "run_duplicate_ranks": run_duplicate_ranks,
    "stream_daily_kpis": stream_daily_kpis,
    "stream_passed_files": stream_passed_files,
    "stream_resent_file": stream_resent_file,
}
