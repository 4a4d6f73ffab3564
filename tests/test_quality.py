from __future__ import annotations

import pytest
from conftest import rows_of, write_file
from pyspark.sql import functions as F

from listenlytics.operators import profile_files, validate_files
from listenlytics.sources import inspect_files, land_plays, read_plays
from listenlytics.sources.plays import READ_ORDER

HEADER = "user_id,track_id,listen_time"
TIME = "2024-01-15 10:00:00"


def lines(n=20, tracks=5, null_users=0, null_tracks=0, user_null="", time=TIME, extra=""):
    return [
        f"{user_null if i < null_users else f'u{i}'},{'' if i < null_tracks else f't{i % tracks}'},{time}{extra}"
        for i in range(n)
    ]


def csv(rows, header=HEADER):
    return "\n".join([header, *rows]) + "\n"


def bad_after(good):
    return [f"u{i},t{i % 7},{TIME}" for i in range(good)] + ["ux,t1,zzz", "uy,t2,"]


NULLS = "Column '{}' has 10.0% null values (threshold 5%)"
UNREADABLE = "Could not read file: "
BAD_TIME = "Column 'listen_time' is not parseable as timestamps"
ONE_TRACK = "Column 'track_id' contains only a single distinct value ('t0') — likely corrupt file"

CASES = {
    "ok": (csv(lines()), ""),
    "header_blanks": (csv(lines(), " User_ID ,TRACK_ID,Listen_Time"), ""),
    "header_quoted": (csv(lines(), '"user_id","track_id","listen_time"'), ""),
    "header_order": (csv([f"{TIME},t{i % 3},u{i}" for i in range(20)], "listen_time,track_id,user_id"), ""),
    "index_column": (csv([f"{i},u{i},t{i % 3},{TIME}" for i in range(20)], "," + HEADER), ""),
    "byte_order_mark": (b"\xef\xbb\xbf" + csv(lines()).encode(), ""),
    "blank_lines": ("\n\n" + csv(lines()) + "\n\n", ""),
    "extra_column": (csv(lines(extra=",x"), HEADER + ",device"), ""),
    "zero_rows": (csv([]), "File contains 0 rows — must have at least 1"),
    "zero_rows_missing_column": ("user_id\n", "File contains 0 rows — must have at least 1"),
    "zero_bytes": ("", UNREADABLE + "No columns to parse from file"),
    "only_blank_lines": ("\n\n", UNREADABLE + "No columns to parse from file"),
    "not_utf8": (csv(lines()).encode() + b"u\xff,t1,2024-01-01\n", UNREADABLE + "not valid UTF-8"),
    "too_many_fields": (csv(lines() + [f"u,t,{TIME},more"]), UNREADABLE + "a row has more fields than the header"),
    "too_many_empty_fields": (csv(lines() + [f"u,t,{TIME},"]), UNREADABLE + "a row has more fields than the header"),
    "quoted_comma": (csv(lines() + [f'"u,1",t,{TIME}']), ""),
    "too_few_fields": (csv(lines(39) + ["u,t"]), ""),
    "missing_column": (csv(["u,t", "u,s"], "user_id,track_id"), "Missing required columns: ['listen_time']"),
    "no_header": (
        "\n".join(lines()),
        "Missing required columns: ['listen_time', 'track_id', 'user_id']",
    ),
    "null_exact": (csv(lines(null_users=1)), ""),
    "null_user": (csv(lines(null_users=2)), NULLS.format("user_id")),
    "null_track": (csv(lines(null_tracks=2)), NULLS.format("track_id")),
    "null_token": (csv(lines(18) + [f"NA,t1,{TIME}", f"null,t2,{TIME}"]), NULLS.format("user_id")),
    "time_all_null": (csv(lines(time="")), "Column 'listen_time' has no non-null values to parse"),
    "time_bad": (csv(lines() + ["u,t,zzz"]), BAD_TIME),
    "time_bad_1000": (csv(bad_after(999)), BAD_TIME),
    "time_bad_1001": (csv(bad_after(1000)), BAD_TIME),
    "one_track": (csv(lines(tracks=1)), ONE_TRACK),
    "one_row": (csv(lines(1)), ONE_TRACK),
    "precedence": (csv(lines(tracks=1, null_users=2)), NULLS.format("user_id")),
    "name with +plus %20 & blank": (csv(lines()), ""),
    "play [1] {a,b}* (x)": (csv(lines()), ""),
}


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("quality root")
    paths = [write_file(root, f"raw/streams/{name}.csv", text) for name, (text, _) in CASES.items()]
    keys = [(f"raw/streams/{name}.csv",) for name in CASES]
    inspection = inspect_files(spark, paths, str(root)).cache()
    plays = land_plays(spark, inspection, str(root), f"{root}/plays")
    return plays, spark.createDataFrame(keys, "source_key string"), inspection


def verdicts_of(df):
    return {r.source_key[len("raw/streams/"):-len(".csv")]: (r.status, r.reason) for r in df.collect()}


def test_every_rule(landed):
    got = verdicts_of(validate_files(*landed))
    expected = {n: ("FAILED" if why else "PASSED", why) for n, (_, why) in CASES.items()}
    assert got == expected


def test_the_first_1000_times(landed):
    got = verdicts_of(validate_files(*landed, sample_rows=1000))
    assert got["time_bad_1001"] == ("PASSED", "")
    assert got["time_bad_1000"] == ("FAILED", BAD_TIME)
    assert got["ok"] == ("PASSED", "")


def test_no_file_with_columns(spark, tmp_path):
    root = str(tmp_path)
    path = write_file(tmp_path, "raw/streams/x.csv", "a,b\n1,2\n")
    inspection = inspect_files(spark, [path], root)
    plays = land_plays(spark, inspection, root, f"{root}/plays")
    files = spark.createDataFrame([("raw/streams/x.csv",)], "source_key string")
    assert rows_of(validate_files(plays, files, inspection), "reason") == [
        ("Missing required columns: ['listen_time', 'track_id', 'user_id']",)
    ]


def test_header_in_a_later_block_is_data(spark, tmp_path):
    """A long file is cut into blocks; only its very first line is the header."""
    text = csv([f"u{i},t{i % 9},{TIME}" for i in range(20000)] + [HEADER])
    path = write_file(tmp_path, "raw/streams/long.csv", text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        inspection = inspect_files(spark, [path], str(tmp_path))
        plays = land_plays(spark, inspection, str(tmp_path), f"{tmp_path}/plays")
        assert plays.select("block").distinct().count() > 5
        found = inspection.first()
        assert (found.line_count, found.header) == (20001, HEADER.split(","))
        profile = profile_files(plays).first()
        assert (profile.row_count, profile.listen_time_bad) == (20001, 1)
        assert profile_files(plays, sample_rows=20001).first().listen_time_bad == 1
        assert profile_files(plays, sample_rows=20000).first().listen_time_bad == 0
        read = read_plays(spark, inspection, str(tmp_path))
        for sample, bad in ((20001, 1), (20000, 0)):
            profile = profile_files(read, order=READ_ORDER, sample_rows=sample)
            assert profile.first().listen_time_bad == bad
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_profile_counts(landed):
    plays = landed[0].where(F.col("source_key") == "raw/streams/null_user.csv")
    row = profile_files(plays).first()
    assert row.asDict() == {
        "source_key": "raw/streams/null_user.csv",
        "row_count": 20,
        "user_id_null_rate": 0.1,
        "track_id_null_rate": 0.0,
        "listen_time_non_null": 20,
        "listen_time_bad": 0,
        "track_id_distinct": 5,
    }
