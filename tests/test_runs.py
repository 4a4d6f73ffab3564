from __future__ import annotations

import os

import pytest
from conftest import rows_of, write_file

from golden import SONGS
from listenlytics.files import list_arrivals, list_files
from listenlytics.objects import look
from listenlytics.operators import read_keyed, route_files
from listenlytics.operators.snapshots import latest
from listenlytics.plans import read_verdicts, run_files, run_inbox, table_paths
from listenlytics.sources import read_catalogue
from listenlytics.streaming import run_stream

HEADER = "user_id,track_id,listen_time\n"


def log(*plays, day="2024-01-15"):
    return HEADER + "".join(f"{user},{track},{day} 10:00:00\n" for user, track in plays)


FIRST = log(("u1", "t1"), ("u2", "t1"), ("u2", "t3"), ("u3", "t3"), ("u3", "t2"))
SECOND = log(("u1", "t1"), ("u1", "t4"))
OTHER_DAY = log(("u1", "t3"), ("u4", "t8"), day="2024-01-16")
BROKEN = HEADER + "u1,t1\nu2,t2,2024-01-15 10:00:00,x\n"
ONE_TRACK = log(("u1", "t1"), ("u2", "t1"))

KPIS_FIRST = [("pop", "2024-01-15", 3, 3), ("rock", "2024-01-15", 2, 2)]
KPIS_BOTH = [("pop", "2024-01-15", 2, 1), ("rock", "2024-01-15", 2, 2)]


def place(root, **files):
    """Files of the inbox, each a minute younger than the one before."""
    paths = []
    for age, (name, text) in enumerate(files.items()):
        paths.append(write_file(root, f"raw/streams/{name}.csv", text, mtime=1_700_000_000 + 60 * age))
    return paths


def catalogue(spark, root):
    return read_catalogue(spark, write_file(root, "raw/songs/songs.csv", SONGS))


def kpis(spark, root):
    table = read_keyed(
        spark, table_paths(str(root))["daily_genre_kpis"],
        "genre string, date date, listen_count long, unique_listeners long",
    )
    return sorted((r.genre, str(r.date), r.listen_count, r.unique_listeners) for r in table.collect())


def names(root, folder):
    return sorted(os.path.basename(path) for path, _ in _files(root / folder))


def _files(folder):
    found = []
    for base, _, files in os.walk(folder):
        found += [(os.path.join(base, f), f) for f in files if not f.startswith((".", "_"))]
    return found


def test_good_and_bad_files(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    place(tmp_path, first=FIRST, other=OTHER_DAY, broken=BROKEN, one=ONE_TRACK, empty="")
    run_inbox(spark, songs, str(tmp_path), "r1")

    verdicts = {r.source_key: (r.status, r.result_key) for r in read_verdicts(spark, str(tmp_path), "r1").collect()}
    assert {k for k, v in verdicts.items() if v[0] == "PASSED"} == {
        "raw/streams/first.csv",
        "raw/streams/other.csv",
    }
    assert verdicts["raw/streams/first.csv"][1] == "tmp/validation/raw/streams/first.csv.result.json"
    assert names(tmp_path, "raw/streams") == []
    assert names(tmp_path, "processed/streams") == ["first.csv", "other.csv"]
    assert names(tmp_path, "quarantine/streams") == ["broken.csv", "empty.csv", "one.csv"]
    assert (tmp_path / "processed/streams/first.csv").read_text() == FIRST
    assert kpis(spark, tmp_path) == sorted(
        KPIS_FIRST + [("jazz", "2024-01-16", 1, 1), ("pop", "2024-01-16", 1, 1), ("rock", "2024-01-16", 1, 1)]
    )
    top = read_keyed(spark, table_paths(str(tmp_path))["top_songs_per_genre"])
    assert rows_of(top.where("genre_date = 'pop#2024-01-15'"), "rank", "track_id", "play_count") == [
        (1, "t1", 2),
        (2, "t2", 1),
    ]
    genres = read_keyed(spark, table_paths(str(tmp_path))["top_genres_per_day"])
    assert rows_of(genres.where("date = '2024-01-15'"), "rank", "genre") == [(1, "pop"), (2, "rock")]


@pytest.mark.parametrize("together", [True, False])
def test_the_file_that_arrived_last_wins_its_keys(spark, tmp_path, together):
    songs = catalogue(spark, tmp_path)
    paths = place(tmp_path, zfirst=FIRST, asecond=SECOND)
    if together:
        run_files(spark, paths, songs, str(tmp_path), "r1")
    else:
        for number, path in enumerate(paths):
            run_files(spark, [path], songs, str(tmp_path), f"r{number}")
    assert kpis(spark, tmp_path) == KPIS_BOTH
    top = read_keyed(spark, table_paths(str(tmp_path))["top_songs_per_genre"])
    assert rows_of(top.where("genre_date = 'pop#2024-01-15'"), "rank", "track_id") == [(1, "t4"), (2, "t1")]


def test_a_run_that_stopped_after_the_load_only_files_away(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    paths = place(tmp_path, zfirst=FIRST, asecond=SECOND)
    run_files(spark, paths, songs, str(tmp_path), "r1", move_files=False)
    assert names(tmp_path, "raw/streams") == ["asecond.csv", "zfirst.csv"]
    os.makedirs(tmp_path / "processed/streams")
    os.rename(paths[1], tmp_path / "processed/streams/asecond.csv")
    run_files(spark, paths[:1], songs, str(tmp_path), "r1")
    assert kpis(spark, tmp_path) == KPIS_BOTH
    assert names(tmp_path, "processed/streams") == ["asecond.csv", "zfirst.csv"]
    stranger = place(tmp_path, stranger=OTHER_DAY)
    with pytest.raises(ValueError, match="already done"):
        run_files(spark, stranger, songs, str(tmp_path), "r1")
    assert names(tmp_path, "raw/streams") == ["stranger.csv"]


def test_an_error_leaves_the_files_and_the_run_can_be_repeated(spark, tmp_path):
    paths = place(tmp_path, first=FIRST)
    songs = catalogue(spark, tmp_path)
    with pytest.raises(Exception, match="(?i)column|track_genre"):
        run_files(spark, paths, songs.drop("track_genre"), str(tmp_path), "r1")
    assert names(tmp_path, "raw/streams") == ["first.csv"]
    run_files(spark, paths, songs, str(tmp_path), "r1")
    assert kpis(spark, tmp_path) == KPIS_FIRST


def test_a_track_under_two_names(spark, tmp_path):
    text = SONGS + "t1,pop,200000,Alpha (live),Ann\n"
    songs = read_catalogue(spark, write_file(tmp_path, "raw/songs/songs.csv", text))
    paths = place(tmp_path, first=FIRST)
    paths += place(tmp_path, other=OTHER_DAY)
    run_files(spark, paths, songs, str(tmp_path), "r1")
    verdicts = {r.source_key: r for r in read_verdicts(spark, str(tmp_path), "r1").collect()}
    assert verdicts["raw/streams/first.csv"].status == "FAILED"
    assert "more than once" in verdicts["raw/streams/first.csv"].reason
    assert verdicts["raw/streams/other.csv"].status == "PASSED"
    assert names(tmp_path, "quarantine/streams") == ["first.csv"]
    assert {day for _, day, _, _ in kpis(spark, tmp_path)} == {"2024-01-16"}
    assert sorted(os.listdir(tmp_path / "tables")) == sorted(table_paths(""))
    paths = place(tmp_path, first=FIRST)
    run_files(spark, paths, songs, str(tmp_path), "r2", on_duplicate="last")
    top = read_keyed(spark, table_paths(str(tmp_path))["top_songs_per_genre"])
    assert rows_of(top.where("genre_date = 'pop#2024-01-15'"), "rank", "track_id", "track_name") == [
        (1, "t1", "Alpha (live)"),
        (3, "t2", 'Beta "live", cut'),
    ]


def test_relative_paths(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    (path,) = place(tmp_path, first=FIRST)
    root = os.path.relpath(tmp_path)
    run_files(spark, [os.path.relpath(path)], songs, root, "r1")
    assert rows_of(read_verdicts(spark, root, "r1"), "source_key", "status") == [
        ("raw/streams/first.csv", "PASSED")
    ]
    assert kpis(spark, tmp_path) == KPIS_FIRST
    assert names(tmp_path, "processed/streams") == ["first.csv"]
    with pytest.raises(ValueError, match="does not lie below"):
        run_files(spark, ["/elsewhere/x.csv"], songs, root, "r2")


def test_empty_inbox(spark, tmp_path):
    assert run_inbox(spark, catalogue(spark, tmp_path), str(tmp_path), "r1") == table_paths(str(tmp_path))
    assert list_files(spark, f"{tmp_path}/none") == []


def test_only_bad_files(spark, tmp_path):
    place(tmp_path, broken=BROKEN, empty="", headless="1,2\n3,4\n")
    run_inbox(spark, catalogue(spark, tmp_path), str(tmp_path), "r1")
    assert names(tmp_path, "quarantine/streams") == ["broken.csv", "empty.csv", "headless.csv"]
    assert kpis(spark, tmp_path) == []


def test_folder_units(spark, tmp_path):
    """Part files of one folder are one unit: neither part alone would pass the check."""
    songs = catalogue(spark, tmp_path)
    place(tmp_path, **{"d1/part-0": log(("u1", "t1")), "d1/part-1": log(("u2", "t3")), "d2/part-0": ONE_TRACK})
    run_inbox(spark, songs, str(tmp_path), "r1", unit="directory")
    assert rows_of(read_verdicts(spark, str(tmp_path), "r1"), "source_key", "status") == [
        ("raw/streams/d1", "PASSED"),
        ("raw/streams/d2", "FAILED"),
    ]
    assert kpis(spark, tmp_path) == [("pop", "2024-01-15", 1, 1), ("rock", "2024-01-15", 1, 1)]
    assert sorted(os.listdir(tmp_path / "processed/streams")) == ["d1"]
    assert names(tmp_path, "processed/streams/d1") == ["part-0.csv", "part-1.csv"]
    assert names(tmp_path, "quarantine/streams/d2") == ["part-0.csv"]


def test_routes(spark):
    verdicts = spark.createDataFrame(
        [("raw/streams/a.csv", "PASSED"), ("raw/streams/b.csv", "FAILED"), ("raw/streams/x/b.csv", "FAILED")],
        "source_key string, status string",
    )
    assert rows_of(route_files(verdicts)) == [
        (key, f"tmp/validation/{key}.result.json", f"processed/kpis/{key}", target)
        for key, target in (
            ("raw/streams/a.csv", "processed/streams/a.csv"),
            ("raw/streams/b.csv", "quarantine/streams/b.csv"),
            ("raw/streams/x/b.csv", "quarantine/streams/x/b.csv"),
        )
    ]


def test_stream_repeats_a_batch_whose_files_were_moved(spark, tmp_path):
    """The query died after the files were filed away, before the batch was committed."""
    songs = catalogue(spark, tmp_path)
    place(tmp_path, first=FIRST, other=OTHER_DAY)
    stream(spark, tmp_path, songs, max_files_per_trigger=None)
    before = kpis(spark, tmp_path)
    for name in ("0", ".0.crc"):
        os.remove(tmp_path / "checkpoint/commits" / name)
    place(tmp_path, second=SECOND)
    stream(spark, tmp_path, songs, max_files_per_trigger=None)
    assert kpis(spark, tmp_path) == sorted([("pop", "2024-01-15", 2, 1), *before[:1], *before[2:]])
    assert names(tmp_path, "processed/streams") == ["first.csv", "other.csv", "second.csv"]


def test_stream_of_folders_takes_whole_folders(spark, tmp_path):
    with pytest.raises(ValueError, match="max_files_per_trigger"):
        stream(spark, tmp_path, None, unit="directory")


def stream(spark, root, songs, **options):
    query = run_stream(spark, lambda: songs, str(root), f"{root}/checkpoint", **options)
    query.awaitTermination()
    return [p for p in query.recentProgress if p["numInputRows"]]


def test_stream_runs_one_file_at_a_time(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    place(tmp_path, zfirst=FIRST, broken=BROKEN, asecond=SECOND)
    stream(spark, tmp_path, songs)
    assert kpis(spark, tmp_path) == KPIS_BOTH
    assert len(os.listdir(tmp_path / "tmp/runs")) == 3 and _files(tmp_path / "tmp/open") == []
    assert names(tmp_path, "processed/streams") == ["asecond.csv", "zfirst.csv"]
    assert names(tmp_path, "quarantine/streams") == ["broken.csv"]

    before = kpis(spark, tmp_path)
    stream(spark, tmp_path, songs)
    assert kpis(spark, tmp_path) == before

    write_file(tmp_path, "raw/streams/other.csv", OTHER_DAY)
    write_file(tmp_path, "raw/streams/nothing.csv", "")
    stream(spark, tmp_path, songs)
    assert ("rock", "2024-01-16", 1, 1) in kpis(spark, tmp_path)
    assert names(tmp_path, "raw/streams") == []
    assert "nothing.csv" in names(tmp_path, "quarantine/streams")


def test_stream_batches_give_the_same_tables(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    place(tmp_path, zfirst=FIRST, broken=BROKEN, asecond=SECOND)
    stream(spark, tmp_path, songs, max_files_per_trigger=None)
    assert kpis(spark, tmp_path) == KPIS_BOTH


def test_stream_repeats_a_batch_that_failed(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    place(tmp_path, first=FIRST)
    with pytest.raises(Exception):
        stream(spark, tmp_path, songs.drop("artists"))
    assert names(tmp_path, "raw/streams") == ["first.csv"]
    stream(spark, tmp_path, songs)
    assert kpis(spark, tmp_path) == KPIS_FIRST
    assert names(tmp_path, "processed/streams") == ["first.csv"]


def test_only_a_mark_stays_of_a_run(spark, tmp_path):
    place(tmp_path, first=FIRST)
    before = work_left(spark)
    run_inbox(spark, catalogue(spark, tmp_path), f"{tmp_path}/", "r1")
    left = [name for name in os.listdir(tmp_path / "tmp/runs/run=r1") if not name.startswith(".")]
    assert left == ["_done"] and _files(tmp_path / "tmp/runs") == []
    assert _files(tmp_path / "tmp/open") == [] and work_left(spark) == before


def work_left(spark):
    folder = os.path.join(spark.conf.get("spark.checkpoint.dir"), "listenlytics")
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def long_log(bad_at):
    rows = [f"u{i},t{i % 3 + 1},2024-01-15 10:00:00" for i in range(bad_at)]
    return HEADER + "\n".join([*rows, "u1,t1,zzz"]) + "\n"


def test_batch_and_stream_give_the_same_verdict(spark, tmp_path):
    """A bad time behind 1500 good ones."""
    verdicts = []
    for way in ("batch", "stream"):
        root = tmp_path / way
        place(root, long=long_log(1500))
        if way == "batch":
            run_inbox(spark, catalogue(spark, root), str(root), "r1")
        else:
            stream(spark, root, catalogue(spark, root))
        (name,) = os.listdir(root / "tmp/runs")
        verdicts.append(rows_of(read_verdicts(spark, str(root), name[4:]), "status", "reason"))
    assert verdicts[0] == verdicts[1] == [("FAILED", "Column 'listen_time' is not parseable as timestamps")]


def test_a_file_sent_again_runs_again(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    place(tmp_path, a=FIRST)
    stream(spark, tmp_path, songs)
    assert kpis(spark, tmp_path) == KPIS_FIRST
    write_file(tmp_path, "raw/streams/a.csv", SECOND, mtime=1_700_009_000)
    stream(spark, tmp_path, songs)
    assert kpis(spark, tmp_path) == KPIS_BOTH
    assert names(tmp_path, "raw/streams") == []
    assert (tmp_path / "processed/streams/a.csv").read_text() == SECOND


def test_a_new_checkpoint_on_an_old_root_and_an_absent_inbox(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    stream(spark, tmp_path, songs)
    place(tmp_path, a=FIRST)
    stream(spark, tmp_path, songs)
    place(tmp_path, b=OTHER_DAY)
    query = run_stream(spark, lambda: songs, str(tmp_path), f"{tmp_path}/another")
    query.awaitTermination()
    assert len(kpis(spark, tmp_path)) == 5 and names(tmp_path, "raw/streams") == []


def test_a_batch_lists_the_inbox_once(spark, tmp_path, monkeypatch):
    from listenlytics.streaming import arrivals

    listed = []

    def count(session, root, folder):
        listed.append(look(session, root, folder).count())
        return look(session, root, folder)

    monkeypatch.setattr(arrivals, "look", count)
    songs = catalogue(spark, tmp_path)
    place(tmp_path, a=FIRST, b=SECOND, c=OTHER_DAY)
    stream(spark, tmp_path, songs)
    assert sum(listed) == 3


def test_tasks_see_what_the_driver_sees(spark, tmp_path):
    for name in ("a.csv", "x/b.csv", "x/y/c d%.csv", "é/d.csv", "_hidden/e.csv", "x/.f.csv", "empty/g.csv"):
        write_file(tmp_path, f"raw/streams/{name}", "" if "empty" in name else name, mtime=1_700_000_000.25)
    seen = {tuple(row) for row in look(spark, str(tmp_path), "raw/streams").collect()}
    assert seen == {tuple(a) for a in list_arrivals(spark, f"{tmp_path}/raw/streams")} and len(seen) == 5
    assert look(spark, str(tmp_path), "raw/absent").count() == 0


def test_a_growing_file_is_read_once_and_whole(spark, tmp_path, monkeypatch):
    """It grows between the two looks of the first stream, and has settled in the second."""
    from listenlytics.streaming import arrivals

    songs = catalogue(spark, tmp_path)
    place(tmp_path, whole=OTHER_DAY, growing=FIRST[: len(FIRST) // 2])
    sleep, pauses = arrivals.time.sleep, []

    def pause(seconds):
        if seconds != 5:  # another thread's, such as py4j's
            return sleep(seconds)
        pauses.append(seconds)
        if len(pauses) == 1:
            write_file(tmp_path, "raw/streams/growing.csv", FIRST)

    monkeypatch.setattr(arrivals.time, "sleep", pause)
    stream(spark, tmp_path, songs, settle=5)
    assert names(tmp_path, "raw/streams") == ["growing.csv"] and names(tmp_path, "processed/streams") == ["whole.csv"]
    stream(spark, tmp_path, songs, settle=5)
    assert names(tmp_path, "raw/streams") == [] and names(tmp_path, "processed/streams") == ["growing.csv", "whole.csv"]
    both = tmp_path / "both"
    run_files(spark, place(both, whole=OTHER_DAY, growing=FIRST), catalogue(spark, both), str(both), "r1")
    assert kpis(spark, tmp_path) == kpis(spark, both)


def test_a_newer_version_is_not_filed_away(spark, tmp_path, monkeypatch):
    """A file is sent again after the run has read it and before it is moved."""
    from listenlytics.plans import run

    (path,) = place(tmp_path, a=FIRST)
    songs = catalogue(spark, tmp_path)
    away = run._file_away

    def late(*args):
        write_file(tmp_path, "raw/streams/a.csv", SECOND, mtime=1_700_009_000)
        away(*args)

    monkeypatch.setattr(run, "_file_away", late)
    run_files(spark, [path], songs, str(tmp_path), "r1")
    assert names(tmp_path, "raw/streams") == ["a.csv"]
    monkeypatch.undo()
    stream(spark, tmp_path, songs)
    assert kpis(spark, tmp_path) == KPIS_BOTH


def test_a_stream_finishes_what_died_after_the_load(spark, tmp_path, monkeypatch):
    """The older file must not be loaded once more behind the newer one."""
    from listenlytics.plans import run

    songs = catalogue(spark, tmp_path)
    place(tmp_path, zfirst=FIRST, asecond=SECOND)

    def die(*args):
        os.remove(tmp_path / "raw/streams/asecond.csv")
        raise RuntimeError("dies")

    monkeypatch.setattr(run, "_file_away", die)
    with pytest.raises(Exception, match="dies"):
        stream(spark, tmp_path, songs, max_files_per_trigger=None)
    monkeypatch.undo()
    assert _files(tmp_path / "tmp/open") != []
    stream(spark, tmp_path, songs, max_files_per_trigger=None)
    assert kpis(spark, tmp_path) == KPIS_BOTH
    assert names(tmp_path, "raw/streams") == [] and _files(tmp_path / "tmp/open") == []


def all_tables(spark, root):
    tables = {name: read_keyed(spark, path) for name, path in table_paths(str(root)).items()}
    return {name: rows_of(table, *sorted(table.columns)) for name, table in tables.items()}


@pytest.mark.parametrize("mode", ["replace", "replace_group"])
def test_one_run_and_several_give_the_same_tables(spark, tmp_path, mode):
    fewer = log(("u1", "t4"), ("u2", "t3"))
    states = []
    for way in ("one", "several"):
        root = tmp_path / way
        songs = catalogue(spark, root)
        paths = place(root, zfirst=FIRST, asecond=fewer, other=OTHER_DAY)
        for number, part in enumerate([paths] if way == "one" else [[p] for p in paths]):
            run_files(spark, part, songs, str(root), f"r{number}", mode=mode)
        states.append(all_tables(spark, root))
    assert states[0] == states[1]
    ranks = [r for r in states[0]["top_songs_per_genre"] if "pop#2024-01-15" in r]
    assert len(ranks) == (1 if mode == "replace_group" else 2)


def test_an_error_in_one_table_leaves_all_three(spark, tmp_path, monkeypatch):
    from listenlytics.plans import run

    songs = catalogue(spark, tmp_path)
    run_files(spark, place(tmp_path, first=FIRST), songs, str(tmp_path), "r1")
    before = all_tables(spark, tmp_path)
    stage = run.stage_state

    def fails(base, name, *args, **options):
        if name == "top_genres_per_day":
            raise RuntimeError("dies")
        return stage(base, name, *args, **options)

    monkeypatch.setattr(run, "stage_state", fails)
    paths = place(tmp_path, second=SECOND)
    with pytest.raises(RuntimeError):
        run_files(spark, paths, songs, str(tmp_path), "r2")
    assert all_tables(spark, tmp_path) == before
    monkeypatch.undo()
    run_files(spark, paths, songs, str(tmp_path), "r2")
    assert kpis(spark, tmp_path) == KPIS_BOTH
    assert sorted(os.listdir(tmp_path / "tables")) == sorted(before)


@pytest.mark.parametrize("point", ["before the commit", "in the commit", "after the commit", "in the moves"])
def test_a_death_leaves_all_old_or_all_new(spark, tmp_path, monkeypatch, point):
    from listenlytics.operators import snapshots
    from listenlytics.plans import run

    songs = catalogue(spark, tmp_path)
    run_files(spark, place(tmp_path, first=FIRST), songs, str(tmp_path), "r1")
    before = all_tables(spark, tmp_path)

    def dies(*args, **options):
        raise RuntimeError("dies")

    module, name = {
        "before the commit": (run, "update"),
        "in the commit": (snapshots, "create_once"),
        "after the commit": (run, "_write_results"),
        "in the moves": (run, "move_in_tasks"),
    }[point]
    monkeypatch.setattr(module, name, dies)
    paths = place(tmp_path, second=SECOND)
    with pytest.raises(RuntimeError):
        run_files(spark, paths, songs, str(tmp_path), "r2")
    monkeypatch.undo()
    seen = all_tables(spark, tmp_path)
    assert (kpis(spark, tmp_path) == KPIS_BOTH) if point in ("after the commit", "in the moves") else seen == before
    run_files(spark, paths, songs, str(tmp_path), "r2")
    assert kpis(spark, tmp_path) == KPIS_BOTH
    assert names(tmp_path, "raw/streams") == []
    # r1: load and filing done; r2 the same, the load by one commit however often it was begun
    assert latest(spark, f"{tmp_path}/tables").version == 4 and not latest(spark, f"{tmp_path}/tables").filing


def test_filed_files_are_not_taken_again(spark, tmp_path, monkeypatch):
    """A file counts as filed from the commit on, though its bytes still lie in the inbox."""
    from listenlytics.plans import run

    songs = catalogue(spark, tmp_path)
    place(tmp_path, first=FIRST)
    monkeypatch.setattr(run, "move_in_tasks", lambda *_: (_ for _ in ()).throw(RuntimeError("dies")))
    with pytest.raises(RuntimeError):
        run_inbox(spark, songs, str(tmp_path), "r1")
    monkeypatch.undo()
    assert names(tmp_path, "raw/streams") == ["first.csv"]
    run_inbox(spark, songs, str(tmp_path), "r2")
    assert names(tmp_path, "raw/streams") == [] and names(tmp_path, "processed/streams") == ["first.csv"]
    assert not (tmp_path / "tmp/runs/run=r2").exists()


def test_results_lie_where_their_keys_say(spark, tmp_path):
    songs = catalogue(spark, tmp_path)
    run_files(spark, place(tmp_path, first=FIRST), songs, str(tmp_path), "r1")
    (row,) = read_verdicts(spark, str(tmp_path), "r1").collect()
    assert spark.read.json(f"{tmp_path}/{row.result_key}").first().status == "PASSED"
    assert row.output_prefix == "processed/kpis/raw/streams/first.csv"
    assert spark.read.parquet(f"{tmp_path}/{row.output_prefix}/daily_genre_kpis").count() == 2


def test_one_text_scan_for_any_number_of_headers(spark, tmp_path):
    from listenlytics.sources import inspect_files, read_plays

    texts = [HEADER + "u1,t1,2024-01-15 10:00:00\n", "track_id,user_id,listen_time\nt1,u1,2024-01-15 10:00:00\n"]
    paths = place(tmp_path, a=texts[0], b=texts[1], c="x," + texts[0].replace("\nu", "\n1,u"))
    inspection = inspect_files(spark, paths, str(tmp_path), target=f"{tmp_path}/inspection")
    plays = read_plays(spark, inspection, str(tmp_path))
    plan = plays._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan text") == 0 and plan.count("Scan csv") == 3
    assert "Scan text" not in inspection._jdf.queryExecution().executedPlan().toString()
    assert plays.count() == 3


def test_thousands_of_files_are_moved_in_portions(spark, tmp_path, monkeypatch):
    from listenlytics import files
    from listenlytics.files import Arrival, for_each, move

    monkeypatch.setattr(files, "PORTION", 100)
    taken = []

    def given():
        for k in range(2500):
            path = tmp_path / f"in/{k}.csv"
            path.parent.mkdir(exist_ok=True)
            path.write_text("x")
            taken.append(k)
            yield files.arrival(spark, str(path)), k

    most = []

    def one(item):
        source, k = item
        most.append(len(taken) - k)
        move(spark, source, f"{tmp_path}/out/{k}.csv")

    for_each(one, given())
    assert len(os.listdir(tmp_path / "out")) == 2500 and max(most) <= 101
    assert isinstance(files.arrival(spark, f"{tmp_path}/out/1.csv"), Arrival)
