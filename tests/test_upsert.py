from __future__ import annotations

import os
import shutil

import pytest
from conftest import rows_of

from listenlytics.operators import (
    DuplicateKeyError,
    date_top_genres,
    genre_date_top_songs,
    genre_dates,
    genre_day,
    read_keyed,
    to_documents,
    to_items,
    upsert_by_key,
)
from listenlytics.plans import song_key_columns

KEYS = ["genre", "date"]
SCHEMA = "genre string, date date, listen_count long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "genre string, date string, listen_count long").selectExpr(
        "genre", "cast(date as date) as date", "listen_count"
    )


def state(spark, target):
    return sorted((r.genre, str(r.date), r.listen_count) for r in read_keyed(spark, target, SCHEMA).collect())


A, B, C = ("a", "2024-01-01", 5), ("b", "2024-01-01", 6), ("a", "2024-01-02", 7)


def test_insert_replace_untouched_idempotent(spark, tmp_path):
    target = f"{tmp_path}/t"
    assert state(spark, target) == []
    upsert_by_key(target, frame(spark, A, B, C), KEYS)
    assert state(spark, target) == sorted([A, B, C])
    new = ("a", "2024-01-01", 3)
    for _ in range(2):
        upsert_by_key(target, frame(spark, new), KEYS)
        assert state(spark, target) == sorted([new, B, C])


def test_only_touched_days_are_rewritten(spark, tmp_path):
    target = f"{tmp_path}/t"
    upsert_by_key(target, frame(spark, A, B, C), KEYS)
    day = tmp_path / "t" / "date=2024-01-02"
    before = sorted(os.listdir(day))
    upsert_by_key(target, frame(spark, ("c", "2024-01-01", 1)), KEYS)
    assert sorted(os.listdir(day)) == before
    shutil.rmtree(day)
    day.mkdir()
    (day / "unreadable.parquet").write_text("not opened")
    upsert_by_key(target, frame(spark, ("d", "2024-01-01", 1)), KEYS)
    assert sorted(os.listdir(tmp_path)) == ["t"]


def test_no_new_rows(spark, tmp_path):
    target = f"{tmp_path}/t"
    upsert_by_key(target, frame(spark).limit(0), KEYS)
    assert state(spark, target) == []
    upsert_by_key(target, frame(spark, A), KEYS)
    upsert_by_key(target, frame(spark).limit(0), KEYS)
    assert state(spark, target) == [A]


def test_stale_ranks_stay_unless_whole_groups_are_replaced(spark, tmp_path):
    def ranks(n, value):
        return spark.sql(
            f"select date'2024-01-01' as date, cast(id as int) as rank, '{value}' as genre from range(1, {n + 1})"
        )

    for mode, expected in (("replace", [(1, "y"), (2, "y"), (3, "x")]), ("replace_group", [(1, "y"), (2, "y")])):
        target = f"{tmp_path}/{mode}"
        upsert_by_key(target, ranks(3, "x"), ["date", "rank"], mode=mode)
        upsert_by_key(target, ranks(2, "y"), ["date", "rank"], mode=mode)
        assert rows_of(read_keyed(spark, target), "rank", "genre") == expected


def test_duplicate_keys(spark, tmp_path):
    target = f"{tmp_path}/t"
    twice = frame(spark, A, ("a", "2024-01-01", 9), B)
    upsert_by_key(target, frame(spark, C), KEYS)
    with pytest.raises(DuplicateKeyError, match="more than once"):
        upsert_by_key(target, twice, KEYS)
    assert state(spark, target) == [C]
    upsert_by_key(target, twice, KEYS, on_duplicate="last", newest_by=["listen_count"])
    assert state(spark, target) == sorted([("a", "2024-01-01", 9), B, C])


def test_bad_arguments(spark, tmp_path):
    with pytest.raises(ValueError, match="mode"):
        upsert_by_key(f"{tmp_path}/t", frame(spark, A), KEYS, mode="merge")
    with pytest.raises(ValueError, match="newest_by"):
        upsert_by_key(f"{tmp_path}/t", frame(spark, A), KEYS, on_duplicate="last")


def test_a_run_that_died_while_swapping_is_completed(spark, tmp_path):
    """The table lost a day, but the side folder holds its complete new state."""
    target = f"{tmp_path}/t"
    upsert_by_key(target, frame(spark, A, C), KEYS)
    new = ("a", "2024-01-01", 8)
    frame(spark, new, B).write.parquet(f"{target}__pending")
    (tmp_path / "t__pending" / "_whole").touch()
    for name in os.listdir(tmp_path / "t" / "date=2024-01-01"):
        os.remove(tmp_path / "t" / "date=2024-01-01" / name)
    assert state(spark, target) == sorted([new, B, C])
    upsert_by_key(target, frame(spark, ("z", "2024-01-03", 1)), KEYS)
    assert state(spark, target) == sorted([new, B, C, ("z", "2024-01-03", 1)])


def test_a_run_that_died_before_swapping_is_forgotten(spark, tmp_path):
    target = f"{tmp_path}/t"
    upsert_by_key(target, frame(spark, A), KEYS)
    frame(spark, ("a", "2024-01-01", 99)).write.parquet(f"{target}__pending")
    assert (tmp_path / "t__pending" / "_SUCCESS").exists()  # which says nothing: it may be switched off
    upsert_by_key(target, frame(spark, C), KEYS)
    assert state(spark, target) == sorted([A, C])


def test_lookups_open_one_day(spark, tmp_path):
    target = f"{tmp_path}/kpis"
    upsert_by_key(target, frame(spark, A, B, C), KEYS)
    kpis = read_keyed(spark, target)
    found = genre_day(kpis, "a", "2024-01-01")
    assert [r.listen_count for r in found.collect()] == [5]
    assert len(found.inputFiles()) >= 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(genre), EqualTo(genre,a)]" in plan
    assert [(str(r.date), r.listen_count) for r in genre_dates(kpis, "a").collect()] == [
        ("2024-01-01", 5),
        ("2024-01-02", 7),
    ]


@pytest.mark.parametrize(
    "name", ["genre_day_lookup", "genre_date_top_songs_lookup", "date_top_genres_lookup"]
)
def test_lookup_queries_open_one_day(spark, sf_dir, name):
    from listenlytics.workloads import QUERIES

    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "Exchange" not in plan.replace("Exchange rangepartitioning", "")


def test_song_table(spark, tmp_path):
    songs = spark.createDataFrame(
        [("r#b#2024-01-01", 2, "t2"), ("r#b#2024-01-01", 1, "t1"), ("pop#2024-01-02", 1, "t3")],
        "genre_date string, rank int, track_id string",
    )
    target = f"{tmp_path}/songs"
    upsert_by_key(target, song_key_columns(songs), ["genre_date", "rank"])
    table = read_keyed(spark, target)
    found = genre_date_top_songs(table, "r#b#2024-01-01")
    assert [(r.rank, r.genre, str(r.date)) for r in found.collect()] == [
        (1, "r#b", "2024-01-01"),
        (2, "r#b", "2024-01-01"),
    ]
    assert "PartitionFilters: [isnotnull(date" in found._jdf.queryExecution().executedPlan().toString()
    assert [r.rank for r in date_top_genres(table, "2024-01-01").collect()] == [1, 2]


def test_items(spark):
    df = spark.sql(
        """select * from values
        (1L, 2.5D, 1.23456789D, date'2024-01-05', timestamp'2024-01-05 10:00:00', 'x'),
        (2L, double('NaN'), 0.0000005D, null, timestamp'2024-01-05 10:00:00.5', null)
        as t(n, a, b, d, ts, s)"""
    )
    first, second = to_items(df).orderBy("n").collect()
    assert (str(first.a), str(first.b)) == ("2.500000", "1.234568")
    assert (first.d, first.ts, first.s) == ("2024-01-05", "2024-01-05T10:00:00", "x")
    assert second.a is None and second.b == 0
    assert second.ts == "2024-01-05T10:00:00.500000"
    documents = sorted(r.document for r in to_documents(df).collect())
    assert '"a":' not in documents[1] and '"s":' not in documents[1] and '"d":' not in documents[1]


def test_infinite_numbers_raise(spark):
    with pytest.raises(Exception, match="infinite number"):
        to_items(spark.sql("select double('Infinity') as a")).collect()
