"""Line breaks in quoted fields, in files of one and of many blocks."""

from __future__ import annotations

import csv
import io
import random
from contextlib import contextmanager

import pandas as pd
import pytest

from conftest import write_file
from listenlytics.operators import validate_files
from listenlytics.sources import inspect_files, land_plays, read_plays, records
from listenlytics.workloads import csv_line_breaks

HEADER = "user_id,note,track_id,listen_time"
TIME = "2024-01-15 10:00:00"


@contextmanager
def blocks_of(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def read(spark, root, *texts):
    paths = [write_file(root, f"raw/streams/f{i}.csv", text) for i, text in enumerate(texts)]
    return read_plays(spark, inspect_files(spark, paths, str(root)), str(root), keep=["note"])


def fields(df):
    rows = df.orderBy("source_key", "block", "row").collect()
    return [(r.user_id, r.note, r.track_id, r.listen_time) for r in rows]


def random_file(seed, rows):
    """A file with every kind of field, and what Python's reader makes of it."""
    draw = random.Random(seed)
    parts = ["a", "bc", ",", '"', "\n", "\n\n", "\n,", '"\n"', " "]
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    for i in range(rows):
        note = "".join(draw.choices(parts, k=draw.choice([1, 3, 60])))
        writer.writerow([f"u{i}", note, f"t{i % 7}", TIME])
    return out.getvalue()


@pytest.mark.parametrize("size", ["40", "100", "1000", "1m"])
def test_any_records_in_blocks_of_any_size(spark, tmp_path, size):
    texts = [random_file(seed, 40) for seed in range(3)]
    with blocks_of(spark, size):
        got = fields(read(spark, tmp_path, *[f"{HEADER}\n{text}" for text in texts]))
    want = [tuple(row) for text in texts for row in csv.reader(io.StringIO(text))]
    assert got == want


@pytest.mark.parametrize(
    "rows",
    [
        'u1,5" pipe,t1,x\nu2,"a\nb",t2,x\n',  # a quote inside a field without quotes is a letter
        'u1,"a ""q"" \n""",t1,x\nu2,,t2,x\n',
        'u1,"x\n",t1,x\n\n\nu2,"\n\n\n",t2,x\n\n',  # blank lines between records are none
        'u1,"",t1,x\nu2,"""",t2,x\nu3,"\n""",t3,x',  # no line end at the end
        'u1,"a\r\nb",t1,x\r\nu2,c,t2,x\r\n',
        'u1,"ends with \\\\",t1,x\nu2,"\n",t2,x\n',  # a backslash is a letter
        '"u\n1","a","t1","x"\n',
    ],
)
def test_as_the_reference_reader_has_them(spark, tmp_path, rows):
    want = pd.read_csv(io.StringIO(f"{HEADER}\n{rows}".replace("\r\n", "\n")), dtype=str, keep_default_na=False)
    for size in ("7", "1m"):
        with blocks_of(spark, size):
            got = fields(read(spark, tmp_path, f"{HEADER}\n{rows}"))
        assert [tuple(v or "" for v in row) for row in got] == [tuple(r) for r in want.to_numpy()]


def landed(spark, root, text, size):
    path = write_file(root, "raw/streams/f.csv", text)
    with blocks_of(spark, size):
        inspection = inspect_files(spark, [path], str(root))
        plays = land_plays(spark, inspection, str(root), f"{root}/plays-{size}")
        files = spark.createDataFrame([("raw/streams/f.csv",)], "source_key string")
        return plays, validate_files(plays, files, inspection).first(), files, inspection


@pytest.mark.parametrize("size", ["50", "1m"])
def test_a_field_that_is_never_closed_fails_its_file(spark, tmp_path, size):
    rows = "".join(f"u{i},n,t{i},{TIME}\n" for i in range(20))
    _, verdict, _, _ = landed(spark, tmp_path, f'{HEADER}\n{rows}u,"open,t,{TIME}\n{rows}', size)
    assert verdict.reason == "Could not read file: a quoted field is not closed"


def test_an_endless_record_fails_its_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "MAX_RECORD_CHARS", 200)
    rows = "".join(f"u{i},n,t{i},{TIME}\n" for i in range(20))
    text = f'{HEADER}\n{rows}u,"{"word\n" * 200}",t,{TIME}\n{rows}'
    assert landed(spark, tmp_path, text, "100")[1].status == "FAILED"
    assert landed(spark, tmp_path, text, "1m")[1].status == "PASSED"


def test_the_first_rows_are_told_in_order(spark, tmp_path):
    """Records keep their order in the landed table, across blocks."""
    good = "".join(f'u{i},"a\nb",t{i % 5},{TIME}\n' for i in range(30))
    bad = 'u,"a\nb",t,zzz\n'
    plays, verdict, files, inspection = landed(spark, tmp_path, f"{HEADER}\n{good}{bad}{good}", "90")
    assert verdict.status == "FAILED"
    status = lambda n: validate_files(plays, files, inspection, sample_rows=n).first().status
    assert (status(30), status(31)) == ("PASSED", "FAILED")


def test_files_without_breaks_need_no_second_scan(spark, tmp_path):
    plan = read(spark, tmp_path, f'{HEADER}\nu,"a ""b"", c",t,{TIME}\n')
    assert "Window" not in plan._jdf.queryExecution().toString()


def test_the_query_in_many_blocks(spark, sf_dir):
    whole = csv_line_breaks(spark, sf_dir).collect()
    with blocks_of(spark, "8k"):
        cut = csv_line_breaks(spark, sf_dir)
        assert sorted(cut.collect(), key=repr) == sorted(whole, key=repr)
    assert len(whole) == spark.read.parquet(f"{sf_dir}/events.parquet").count()
