"""Skewed inputs against brute force, and the shape of the plans."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from listenlytics.operators import (
    catalogue_fits,
    daily_genre_kpis,
    enrich,
    first_n_per_group,
    song_play_counts,
    top_genres_per_day,
    top_k_per_group,
    top_songs_per_genre,
)
from listenlytics.operators.topk import latest_per_key

DAYS = ["2024-01-15", "2024-01-16"]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the plays are of one track, a third by one user; one track has many copies."""
    plays = []
    for i in range(3000):
        track = "hot" if i % 3 == 0 else f"t{i % 40}"
        user = None if i % 11 == 0 else "fan" if i % 3 == 1 else f"u{i % 97}"
        plays.append((user, track, f"{DAYS[i % 2]} 10:00:{i % 60:02d}"))
    plays += [("u1", None, f"{DAYS[0]} 10:00:00"), ("u1", "t1", "never"), ("u1", "unknown", f"{DAYS[0]} 10:00:00")]
    songs = [(f"t{i}", f"g{i % 4}", str(1000 + i), f"name {i}", "artist") for i in range(40)]
    songs += [("hot", "g0", "500", "hot", "artist")] * 20
    songs += [("hot", "g0", "500", f"hot {i}", None) for i in range(10)]
    songs += [("t1", "g9", "7", "name 1", "artist"), ("t2", None, "7", "x", "y"), ("t3", "g1", "bad", "x", "y")]
    return (
        spark.createDataFrame(plays, "user_id string, track_id string, listen_time string").repartition(7),
        spark.createDataFrame(
            songs,
            "track_id string, track_genre string, duration_ms string, track_name string, artists string",
        ),
        plays,
        songs,
    )


def brute_force(plays, songs):
    joined = [
        (user, track, time[:10], genre, int(ms), name, artists)
        for user, track, time in plays
        if track is not None and time[:4] == "2024"
        for song_track, genre, ms, name, artists in songs
        if song_track == track and genre is not None and ms.isdigit()
    ]
    groups = defaultdict(list)
    for row in joined:
        groups[row[3], row[2]].append(row)
    kpis = []
    for (genre, day), rows in groups.items():
        users = len({r[0] for r in rows if r[0] is not None})
        total = sum(r[4] for r in rows)
        kpis.append((genre, day, len(rows), users, total, total // users if users else None))
    counts = Counter((r[3], r[2], r[1], r[5], r[6]) for r in joined)
    return joined, sorted(kpis), counts


def ranked(items, group, order, k):
    """(rank, item) for all items of rank at most k, by counting the better ones."""
    result = []
    for item in items:
        better = sum(1 for other in items if group(other) == group(item) and order(other) > order(item))
        if better < k:
            result.append((better + 1, item))
    return result


@pytest.fixture(params=["broadcast", "shuffle"])
def small(request, spark):
    if request.param == "broadcast":
        yield True
        return
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield False
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_kpis(skewed, small):
    plays, songs, *raw = skewed
    joined, kpis, _ = brute_force(*raw)
    got = daily_genre_kpis(plays, songs, small_catalogue=small)
    assert sorted((r[0], str(r[1]), *r[2:]) for r in got.collect()) == kpis
    assert enrich(plays, songs, small_catalogue=small).count() == len(joined)


def test_song_counts_and_rankings(skewed, small):
    plays, songs, *raw = skewed
    _, kpis, counts = brute_force(*raw)
    got = song_play_counts(plays, songs, small_catalogue=small)
    assert rows_of(got.withColumn("date", F.col("date").cast("string"))) == sorted(
        ((*key, n) for key, n in counts.items()), key=repr
    )
    items = [(*key, n) for key, n in counts.items()]
    for ties, order in (("break", lambda c: (c[5], c[2])), ("keep", lambda c: c[5])):
        expected = sorted(
            (f"{c[0]}#{c[1]}", rank, c[2], c[3], c[5])
            for rank, c in ranked(items, lambda c: c[:2], order, 3)
        )
        top = top_songs_per_genre(got, ties=ties)
        assert rows_of(top, "genre_date", "rank", "track_id", "track_name", "play_count") == sorted(expected, key=repr)
    for ties, order in (("break", lambda k: (k[2], k[0])), ("keep", lambda k: k[2])):
        top = top_genres_per_day(daily_genre_kpis(plays, songs, small_catalogue=small), k=2, ties=ties)
        expected = sorted((k[1], rank, k[0], k[2]) for rank, k in ranked(kpis, lambda k: k[1], order, 2))
        assert sorted((str(r[0]), *r[1:]) for r in top.collect()) == expected


def test_groups_per_file(skewed):
    plays, songs, raw_plays, raw_songs = skewed
    two = plays.withColumn("source_key", F.lit("a")).unionByName(plays.limit(0).withColumn("source_key", F.lit("b")))
    got = daily_genre_kpis(two, songs, by=["source_key"])
    assert sorted((r[1], str(r[2]), *r[3:]) for r in got.collect()) == brute_force(raw_plays, raw_songs)[1]


def test_top_k_keeps_every_tie(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), (F.col("id") % 3).alias("v"), "id")
    top = top_k_per_group(df, ["g"], ["v"], 1, ties="keep")
    assert top.count() == 1666 and {r.rank for r in top.select("rank").distinct().collect()} == {1}
    with pytest.raises(ValueError):
        top_k_per_group(df, ["g"], ["v"], 1, ties="some")


def test_first_n_of_a_group_in_many_partitions(spark):
    df = (
        spark.range(20000)
        .select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("g"), "id")
        .repartition(37)
    )
    got = defaultdict(list)
    for row in first_n_per_group(df, ["g"], ["id"], 100).collect():
        got[row.g].append(row.id)
    expected = defaultdict(list)
    for i in range(20000):
        expected["hot" if i % 3 == 0 else str(i % 50)].append(i)
    assert {g: sorted(ids) for g, ids in got.items()} == {g: ids[:100] for g, ids in expected.items()}


def test_latest_per_key(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 2, "c"), ("l", 1, "d")], "k string, t int, v string")
    assert rows_of(latest_per_key(df, ["k"], ["t"])) == [("k", 2, "b"), ("k", 2, "c"), ("l", 1, "d")]


def test_catalogue_size_is_measured(skewed):
    songs = skewed[1]
    assert catalogue_fits(songs)
    assert not catalogue_fits(songs, limit=1000)
    assert catalogue_fits(songs.limit(0), limit=0)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, skewed, tmp_path):
    plays, songs, *_ = skewed
    plays.write.parquet(f"{tmp_path}/plays")
    songs.write.parquet(f"{tmp_path}/songs")
    plays, songs = spark.read.parquet(f"{tmp_path}/plays"), spark.read.parquet(f"{tmp_path}/songs")
    kpis = plan_of(daily_genre_kpis(plays, songs))
    counts = song_play_counts(plays, songs)
    top = plan_of(top_songs_per_genre(counts))
    tied = plan_of(top_songs_per_genre(counts, ties="keep"))
    shuffled = plan_of(daily_genre_kpis(plays, songs, small_catalogue=False).hint("merge"))

    assert "BroadcastHashJoin [track_id" in kpis
    assert "partial_sum" in kpis and "SortAggregate" not in kpis
    assert kpis.count("Exchange hashpartitioning(track_genre") == 2
    assert "ReadSchema: struct<track_id:string,track_genre:string,duration_ms:string>" in kpis
    assert "SortAggregate" not in top and "partial_count(1)" in top
    assert top.count("WindowGroupLimit") == 2
    assert "ReadSchema: struct<track_id:string,listen_time:string>" in top
    assert "row_number(), 3, Partial" in tied
    for plan in (kpis, top, tied, shuffled):
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        assert "python" not in plan.lower()


def test_ranked_counts_are_sorted_by_other_tasks(spark):
    """What adds up the plays hands narrow counts on, so no task holds its sums and sorts them as well."""
    plays = spark.createDataFrame(
        [(str(k % 7), f"2024-01-0{k % 3 + 1} 10:00:00", k) for k in range(60)],
        "track_id string, listen_time string, user_id long",
    )
    songs = spark.createDataFrame(
        [(str(k), f"g{k % 2}", 10, f"n{k}", "a") for k in range(7)],
        "track_id string, track_genre string, duration_ms long, track_name string, artists string",
    )
    plain = top_songs_per_genre(song_play_counts(plays, songs))
    for ties in ("break", "keep"):
        ranked = top_songs_per_genre(song_play_counts(plays, songs, ranked=True), ties=ties)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        below_limit = plan[plan.rindex("WindowGroupLimit") :]
        assert "REPARTITION_BY_COL" in below_limit[: below_limit.index("functions=[count(1)]")]
    ranked = top_songs_per_genre(song_play_counts(plays, songs, ranked=True))
    assert rows_of(ranked) == rows_of(plain) and ranked.count() == 18
