"""Tables under one version: commits, conflicts, pinned readers; files moved by tasks."""

import os
import threading

import pytest
from conftest import rows_of

from listenlytics.files import create_once, list_arrivals
from listenlytics.objects import move_files, write_objects
from listenlytics.operators import read_keyed, upsert_by_key
from listenlytics.operators import snapshots as sn
from listenlytics.staging import written

COLUMNS = "k string, date date, v long"


def rows(spark, folder, *values):
    import datetime

    made = [(k, d and datetime.date.fromisoformat(d), v) for k, d, v in values]
    return written(spark.createDataFrame(made, COLUMNS), f"{folder}/{os.urandom(6).hex()}")


def put(spark, tmp_path, root, load=None, **tables):
    """One commit that upserts rows into several tables."""

    def stage(base):
        return {
            name: sn.stage_state(base, name, rows(spark, tmp_path, *values), ["k", "date"])
            for name, values in tables.items()
        }

    return sn.update(spark, root, stage, load)


def seen(found, spark):
    return {name: rows_of(found.read(spark, name), "k", "v") for name in found.schemas}


def test_versions_are_whole_and_stay(spark, tmp_path):
    root = f"{tmp_path}/tables"
    assert sn.latest(spark, root).version == 0
    first = put(spark, tmp_path, root, a=[("x", "2024-01-01", 1), ("y", "2024-01-02", 2)], b=[("x", None, 5)])
    second = put(spark, tmp_path, root, a=[("x", "2024-01-01", 3), ("z", "2024-01-03", 4)], b=[("w", None, 6)])
    assert seen(second, spark) == {"a": [("x", 3), ("y", 2), ("z", 4)], "b": [("w", 6), ("x", 5)]}
    assert seen(sn.snapshot(spark, root, first.version), spark) == {"a": [("x", 1), ("y", 2)], "b": [("x", 5)]}
    # the untouched day is not written again
    folder = "date=2024-01-02"
    assert first.states["a"][folder] == second.states["a"][folder]
    assert rows_of(read_keyed(spark, f"{root}/a", "v long"), "v") == [(2,), (3,), (4,)]
    one = second.read(spark, "a").where("date = date'2024-01-02'")
    assert len(one.inputFiles()) == 3 and one.count() == 1  # all are known, one is opened
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="version"):
        upsert_by_key(f"{root}/a", spark.createDataFrame([], COLUMNS), ["k"])


def test_one_of_two_writers_commits_and_the_other_does_it_again(spark, tmp_path):
    root = f"{tmp_path}/tables"
    put(spark, tmp_path, root, a=[("x", "2024-01-01", 1)])
    base = sn.latest(spark, root)
    slow = {"a": sn.stage_state(base, "a", rows(spark, tmp_path, ("y", "2024-01-01", 2)), ["k", "date"])}
    put(spark, tmp_path, root, a=[("z", "2024-01-01", 3)])
    with pytest.raises(sn.ConflictError):
        sn.commit(spark, base, slow)
    staged = []

    def stage(latest):
        staged.append(latest.version)
        if len(staged) == 1:  # another one is faster
            put(spark, tmp_path, root, a=[("w", "2024-01-01", 4)])
        return {"a": sn.stage_state(latest, "a", rows(spark, tmp_path, ("y", "2024-01-01", 2)), ["k", "date"])}

    found = sn.update(spark, root, stage)
    assert staged == [2, 3]
    assert seen(found, spark) == {"a": [("w", 4), ("x", 1), ("y", 2), ("z", 3)]}


def test_writers_of_other_days_do_not_stage_again(spark, tmp_path):
    root = f"{tmp_path}/tables"
    put(spark, tmp_path, root, a=[("x", "2024-01-01", 1)])
    staged = []

    def stage(latest):
        staged.append(latest.version)
        put(spark, tmp_path, root, a=[("z", "2024-01-05", 3)])
        return {"a": sn.stage_state(latest, "a", rows(spark, tmp_path, ("y", "2024-01-02", 2)), ["k", "date"])}

    assert seen(sn.update(spark, root, stage), spark) == {"a": [("x", 1), ("y", 2), ("z", 3)]}
    assert staged == [1]


def test_many_writers_at_a_time(spark, tmp_path):
    root = f"{tmp_path}/tables"

    def one(i):
        put(spark, tmp_path, root, load=f"load{i}", a=[(f"k{i}", "2024-01-01", i)])

    threads = [threading.Thread(target=one, args=(i,)) for i in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    found = sn.latest(spark, root)
    assert found.version == 6 and seen(found, spark) == {"a": [(f"k{i}", i) for i in range(6)]}
    assert put(spark, tmp_path, root, load="load3", a=[("other", "2024-01-01", 9)]) == found  # done before


def test_only_one_creates_a_file(spark, tmp_path):
    made = []
    threads = [
        threading.Thread(target=lambda i=i: made.append(create_once(spark, f"{tmp_path}/v/x", f"{i}"))) for i in range(8)
    ]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(made) == [False] * 7 + [True]
    assert [n for n in os.listdir(tmp_path / "v") if not n.startswith(".")] == ["x"]


def test_clean_keeps_what_versions_name(spark, tmp_path):
    root = f"{tmp_path}/tables"
    for i in range(4):
        found = put(spark, tmp_path, root, a=[("x", "2024-01-01", i)])
    sn.stage_state(found, "a", rows(spark, tmp_path, ("y", "2024-01-01", 2)), ["k", "date"])  # never committed
    assert sn.clean(spark, root, keep=2) == 0  # too young
    assert sn.clean(spark, root, keep=2, older_than_ms=0) == 3
    assert seen(sn.snapshot(spark, root, 3), spark) == {"a": [("x", 2)]}
    assert seen(sn.latest(spark, root), spark) == {"a": [("x", 3)]}
    assert put(spark, tmp_path, root, a=[("x", "2024-01-01", 9)]).version == 5


def test_tasks_move_thousands_of_files(spark, tmp_path):
    for k in range(3000):
        folder = tmp_path / f"raw/streams/{k % 7}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{k}.csv").write_text(f"{k}")
    root = str(tmp_path)
    arrived = list_arrivals(spark, f"{root}/raw/streams")
    names = [(a.path.split("/raw/")[1], a.length, a.modified) for a in arrived]
    moves = [(f"raw/{n}", size, at, f"processed/{n}") for n, size, at in names]
    (tmp_path / "raw" / names[0][0]).write_text("longer than before")  # sent again
    (tmp_path / "raw" / names[1][0]).unlink()
    (tmp_path / "processed/streams/2").mkdir(parents=True)
    (tmp_path / "processed" / names[5][0]).parent.mkdir(parents=True, exist_ok=True)
    (tmp_path / "processed" / names[5][0]).write_text("an older one")
    frame = spark.createDataFrame(moves, "source string, length long, modified long, target string")
    assert move_files(frame, root) == {"moved": 2998, "newer": 1, "gone": 1}
    assert (tmp_path / "processed" / names[5][0]).read_text() != "an older one"
    assert [a.path.rpartition("/")[2] for a in list_arrivals(spark, f"{root}/raw/streams")] == [names[0][0].rpartition("/")[2]]
    assert move_files(frame, root) == {"newer": 1, "gone": 2999}
    assert move_files(frame.limit(0), root) == {}


def test_tasks_write_objects(spark, tmp_path):
    made = spark.range(1200).selectExpr("concat('out/', id % 3, '/', id, '.json') AS key", "concat('é', id) AS content")
    for _ in range(2):
        write_objects(made, str(tmp_path))
    assert len(list_arrivals(spark, f"{tmp_path}/out")) == 1200
    assert (tmp_path / "out/2/1199.json").read_text(encoding="utf-8") == "é1199"
