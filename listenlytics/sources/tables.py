"""Play logs and catalogues mapped from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as the song catalogue; no play has the keys of small parts, so some plays are unknown."""
    key = F.col("p_partkey").cast("string")
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") <= 5, F.concat(F.lit("unplayed-"), key)).otherwise(key).alias("track_id"),
        F.col("p_type").alias("track_genre"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").alias("duration_ms"),
        F.col("p_name").alias("track_name"),
        F.col("p_brand").alias("artists"),
    )


def _event_track() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1)


def event_plays(events: DataFrame, *keep: str) -> DataFrame:
    """``events`` as a play log, with further columns; the number in ``props`` is the track."""
    track, time = _event_track().alias("track_id"), F.col("ts").alias("listen_time")
    return events.select("event_id", "user_id", track, time, *keep)


def order_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its orders as a large play log."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("l_orderkey").alias("event_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").cast("string").alias("track_id"),
        F.col("l_shipdate").alias("listen_time"),
    )


def yearly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as one long play file for each year, in the order of their keys.

    Unreadable times: in the later half of the keys of 1995, all over 1996.
    """
    orders = table(spark, sf_dir, "orders")
    half = orders.agg(F.max("o_orderkey")).first()[0] // 2
    year, key = F.year("o_orderdate"), F.col("o_orderkey")
    bad = (key % 50 == 0) & (((year == 1995) & (key > half)) | (year == 1996))
    return orders.select(
        key.alias("event_id"),
        F.concat(F.lit("raw/streams/"), year.cast("string"), F.lit(".csv")).alias("source_key"),
        F.col("o_custkey").alias("user_id"),
        (key % 97).cast("string").alias("track_id"),
        F.when(bad, "not-a-time").otherwise(F.col("o_orderdate").cast("string")).alias("listen_time"),
    )


def defective_files(events: DataFrame) -> DataFrame:
    """``events`` as one play file for each day, with defects put in.

    Nulls in user_id on most days, one track only on 7 January, unreadable times on
    9 January, null tracks on 11 January.
    """
    day = F.col("ts").cast("date")
    is_day = lambda d: day == F.lit(f"2024-01-{d:02d}").cast("date")
    event = F.col("event_id")
    clean_users = is_day(7) | is_day(9) | is_day(11)
    return events.select(
        "event_id",
        F.concat(F.lit("raw/streams/"), day.cast("string"), F.lit(".csv")).alias("source_key"),
        F.when(~((event % 10 == 0) & (F.col("user_id") < 75) & ~clean_users), F.col("user_id"))
        .alias("user_id"),
        F.when(is_day(7), "5")
        .when(is_day(11) & (event % 3 == 0), None)
        .otherwise(_event_track())
        .alias("track_id"),
        F.when(is_day(9) & (event % 50 == 0), "not-a-time")
        .otherwise(F.col("ts").cast("string"))
        .alias("listen_time"),
    )
