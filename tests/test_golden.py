from __future__ import annotations

import pytest
from golden import KPIS, SONGS, STREAMS, TOP_GENRES, TOP_SONGS
from conftest import rows_of, write_file
from pyspark.errors import AnalysisException

from listenlytics.operators import (
    daily_genre_kpis,
    enrich,
    kpis_of_enriched,
    song_play_counts,
    top_genres_per_day,
    top_songs_per_genre,
    validate_files,
)
from listenlytics.plans import row_counts, show_summary, write_tables
from listenlytics.sources import inspect_files, read_catalogue, read_parts, read_plays


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("golden")
    songs = write_file(root, "raw/songs/songs.csv", SONGS)
    plays = write_file(root, "raw/streams/streams.csv", STREAMS)
    inspection = inspect_files(spark, [plays], str(root))
    return read_plays(spark, inspection, str(root)), read_catalogue(spark, songs)


def text_dates(rows):
    return [tuple(str(v) if hasattr(v, "isoformat") else v for v in row) for row in rows]


def test_catalogue_quotes(inputs):
    names = {r.track_id: r.track_name for r in inputs[1].collect()}
    assert names["t2"] == 'Beta "live", cut'
    assert inputs[1].columns == ["track_id", "track_genre", "duration_ms", "track_name", "artists"]


def test_enrich(inputs):
    enriched = enrich(*inputs)
    assert enriched.count() == 10
    assert dict(enriched.dtypes)["date"] == "date"
    assert dict(enriched.dtypes)["duration_ms"] == "bigint"


def test_kpis(inputs):
    kpis = daily_genre_kpis(*inputs)
    assert text_dates(rows_of(kpis)) == KPIS
    assert dict(kpis.dtypes) == {
        "genre": "string",
        "date": "date",
        "listen_count": "bigint",
        "unique_listeners": "bigint",
        "total_listening_time_ms": "bigint",
        "avg_listening_time_per_user_ms": "bigint",
    }


def test_kpis_of_enriched_rows_are_the_same(inputs):
    assert rows_of(kpis_of_enriched(enrich(*inputs))) == rows_of(daily_genre_kpis(*inputs))


def test_top_songs(inputs):
    top = top_songs_per_genre(song_play_counts(*inputs))
    assert rows_of(top.drop("artists")) == TOP_SONGS
    assert dict(top.dtypes)["rank"] == "int"


def test_top_songs_with_ties(inputs):
    top = top_songs_per_genre(song_play_counts(*inputs), ties="keep")
    pop = rows_of(top.where("genre_date = 'pop#2024-01-15'"), "rank", "track_id")
    assert pop == [(1, "t1"), (2, "t2"), (2, "t4"), (2, "t5")]


def test_top_genres(inputs):
    kpis = daily_genre_kpis(*inputs)
    assert text_dates(rows_of(top_genres_per_day(kpis))) == TOP_GENRES
    tied = top_genres_per_day(kpis, ties="keep").where("date = '2024-01-16'")
    assert rows_of(tied, "rank", "genre") == [(1, "jazz"), (1, "pop")]


def test_this_file_fails_the_check(inputs):
    assert rows_of(validate_files(inputs[0]), "status", "reason") == [
        ("FAILED", "Column 'user_id' has 7.7% null values (threshold 5%)")
    ]


def test_row_counts_and_summary(inputs, capsys):
    assert rows_of(row_counts(*inputs)) == [(13, 9, 10)]
    show_summary(*inputs)
    printed = capsys.readouterr().out
    assert "pop#2024-01-15" in printed and "323333" in printed


def test_written_tables_read_back(spark, inputs, tmp_path):
    paths = write_tables(*inputs, f"{tmp_path}/out/")
    write_tables(*inputs, f"{tmp_path}/out")
    assert paths["daily_genre_kpis"] == f"{tmp_path}/out/daily_genre_kpis"
    assert text_dates(rows_of(read_parts(spark, paths["daily_genre_kpis"]))) == KPIS
    assert rows_of(read_parts(spark, paths["top_songs_per_genre"]).drop("artists")) == TOP_SONGS
    assert text_dates(rows_of(read_parts(spark, paths["top_genres_per_day"]))) == TOP_GENRES


def test_empty_result_keeps_its_schema(spark, inputs, tmp_path):
    paths = write_tables(inputs[0].limit(0), inputs[1], str(tmp_path))
    for path in paths.values():
        assert read_parts(spark, path).count() == 0


def test_parts_without_files_raise(spark, tmp_path):
    (tmp_path / "none").mkdir()
    with pytest.raises(AnalysisException):
        read_parts(spark, str(tmp_path / "none"))


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_catalogue(spark, f"{tmp_path}/nothing.csv")
