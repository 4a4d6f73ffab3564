"""Times in other layouts than the standard form, one for each file."""

from __future__ import annotations

import pytest

from conftest import rows_of, write_file
from listenlytics.operators import file_layouts, in_file_layouts, read_keyed, validate_files
from listenlytics.operators.layouts import TIME_LAYOUTS
from listenlytics.plans import read_verdicts, run_inbox, table_paths
from listenlytics.sources import inspect_files, land_plays

HEADER = "user_id,track_id,listen_time"
BAD_TIME = "Column 'listen_time' is not parseable as timestamps"
CASES = {  # times; the days in the order of rows; whether all can be read
    "month_first": (["01/15/2024 10:00", "2/3/2024 9:05:07"], ["2024-01-15", "2024-02-03"], True),
    "day_first": (["15/01/2024", "03/02/2024"], ["2024-01-15", "2024-02-03"], True),
    "undecided": (["01/02/2024", "03/04/2024"], ["2024-01-02", "2024-03-04"], True),
    "both": (["01/15/2024", "02/16/2024", "15/01/2024"], ["2024-01-15", "2024-02-16", None], False),
    "half_day": (["1/15/2024 1:30 PM", "1/16/2024 12:00:00 am"], ["2024-01-15", "2024-01-16"], True),
    "dots": (["15.1.2024 8:00", "03.02.2024"], ["2024-01-15", "2024-02-03"], True),
    "slashes": (["2024/01/15 10:00:00", "2024/2/3"], ["2024-01-15", "2024-02-03"], True),
    "names": (['"Jan 15, 2024"', '"Feb 3, 2024 10:00"'], ["2024-01-15", "2024-02-03"], True),
    "beside_standard": (["2024-01-15 10:00:00", "2/3/2024"], ["2024-01-15", "2024-02-03"], True),
    "standard": (["2024-01-15 10:00:00", "2024-02-03T10:00:00"], ["2024-01-15", "2024-02-03"], True),
    "no_such_day": (["13/13/2024", "1/15/2024"], [None, "2024-01-15"], False),
    "nothing": (["soon", "later"], [None, None], False),
    "null_tokens": (["", "1/15/2024"], [None, "2024-01-15"], True),
}


def text_of(times):
    return "\n".join([HEADER, *[f"u{i},t{i},{time}" for i, time in enumerate(times)]]) + "\n"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layouts")
    paths = [write_file(root, f"raw/streams/{name}", text_of(times)) for name, (times, _, _) in CASES.items()]
    plays = land_plays(spark, inspect_files(spark, paths, str(root)), str(root), f"{root}/plays")
    return plays, in_file_layouts(plays, f"{root}/layouts")


def test_days_of_each_file(landed):
    got = {(r.source_key, r.track_id): r.date and str(r.date) for r in landed[1].collect()}
    want = {(f"raw/streams/{n}", f"t{i}"): day for n, (_, days, _) in CASES.items() for i, day in enumerate(days)}
    assert got == want


@pytest.mark.parametrize("sample_rows", [None, 1000, 1])
def test_the_check_reads_the_same_times(landed, sample_rows):
    got = {r.source_key: r.reason for r in validate_files(landed[1], sample_rows=sample_rows).collect()}
    late = {"both"} if sample_rows == 1 else set()  # its first time is fine
    want = {f"raw/streams/{n}": "" if fine or n in late else BAD_TIME for n, (_, _, fine) in CASES.items()}
    assert got == want


def test_votes(landed, tmp_path):
    got = {r.source_key[12:]: TIME_LAYOUTS[r.layout] for r in file_layouts(landed[0], str(tmp_path / "v")).collect()}
    assert got["undecided"] == got["month_first"] == TIME_LAYOUTS[0] and got["day_first"] == TIME_LAYOUTS[1]
    assert "standard" not in got and "nothing" not in got


def test_standard_times_cost_no_join(spark, landed, tmp_path):
    plays = landed[0].where("source_key = 'raw/streams/standard'")
    assert in_file_layouts(plays, str(tmp_path / "v")) is plays


def test_a_run_loads_what_its_check_accepts(spark, tmp_path):
    write_file(tmp_path, "raw/streams/us.csv", text_of(["01/15/2024 10:00", "01/16/2024 10:00"]))
    songs = spark.createDataFrame(
        [(f"t{i}", "pop", 1000, f"n{i}", "a") for i in range(2)],
        "track_id string, track_genre string, duration_ms bigint, track_name string, artists string",
    )
    root = str(tmp_path)
    run_inbox(spark, songs, root, "r")
    assert rows_of(read_verdicts(spark, root, "r"), "status") == [("PASSED",)]
    kpis = read_keyed(spark, table_paths(root)["daily_genre_kpis"])
    assert [str(row[0]) for row in rows_of(kpis, "date")] == ["2024-01-15", "2024-01-16"]


def test_a_run_without_inference_refuses_it(spark, tmp_path):
    write_file(tmp_path, "raw/streams/us.csv", text_of(["01/15/2024 10:00", "01/16/2024 10:00"]))
    songs = spark.createDataFrame(
        [("t1", "pop", 1000, "n", "a")],
        "track_id string, track_genre string, duration_ms bigint, track_name string, artists string",
    )
    run_inbox(spark, songs, str(tmp_path), "r", infer_times=False)
    assert rows_of(read_verdicts(spark, str(tmp_path), "r"), "reason") == [(BAD_TIME,)]
