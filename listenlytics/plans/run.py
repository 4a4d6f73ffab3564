"""One run over arrived files: check, transform, load, file away.

Below one root folder, on storage that all executors share:

    raw/streams/...            arrived files
    processed/streams/...      files that passed, moved after the load
    quarantine/streams/...     files that failed
    tmp/validation/run=<id>    verdicts as JSON
    tmp/validation/<key>.result.json   the verdict of one file, where ``result_key`` says
    tmp/open/<id>              runs that are not through yet
    tmp/filing/run=<id>        where the files of a run go, until they are there
    tmp/runs/run=<id>/...      what a run works with; only its mark stays when it is through
    processed/kpis/run=<id>    the result tables of the run, per file; of a run over a
                               single file at processed/kpis/<key>
    tables/<name>              the keyed tables that are served
    tables__versions           their versions, one file each

Every step writes to a path of its run. One commit makes the three tables' new states count
and files the run's inputs; their bytes are moved after it. An error before leaves all as it
was, and a run that died is started again with the same id: before the commit it does
everything again, after that it only moves the other files.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..files import (
    Arrival,
    absolute,
    any_match,
    arrival,
    delete,
    exists,
    list_arrivals,
    plain_path,
    touch,
)
from ..objects import move_files as move_in_tasks
from ..objects import write_objects
from ..operators.enrich import BROADCAST_BYTES, sized
from ..operators.layouts import in_file_layouts
from ..operators.quality import validate_files
from ..operators.routing import INBOX, KPI_OUTPUT, RESULTS, output_prefix, result_key, target_key
from ..operators.topk import latest_per_key
from ..operators.snapshots import Change, Snapshot, latest, snapshot, stage_state, update
from ..operators.upsert import one_row_per_key, read_keyed
from ..sources import inspect_files, land_plays
from ..staging import side_by_side, written
from .transform import KEYS, song_key_columns, write_frames

ARRIVAL = ("arrived_at", "source_key")
_GROUPS = {"daily_genre_kpis": ["date"], "top_songs_per_genre": ["genre_date"], "top_genres_per_day": ["date"]}
OPEN_RUNS = "tmp/open"
_VERDICT_SCHEMA = (
    "source_key string, status string, reason string, result_key string, output_prefix string"
)
_FILE_SCHEMA = "source_key string, path string, length bigint, modified bigint"


@dataclass(frozen=True)
class RunPaths:
    """Where a run keeps what it writes."""

    root: str
    run_id: str

    def _work(self, name: str) -> str:
        return f"{self.root}/tmp/runs/run={self.run_id}/{name}"

    @property
    def work(self) -> str:
        return self._work("work")

    @property
    def files(self) -> str:
        return self._work("files")

    @property
    def loaded(self) -> str:
        return self._work("_loaded")

    @property
    def done(self) -> str:
        return self._work("_done")

    @property
    def filing(self) -> str:
        return f"{self.root}/tmp/filing/run={self.run_id}"

    @property
    def open(self) -> str:
        return f"{self.root}/{OPEN_RUNS}/{self.run_id}"

    @property
    def verdicts(self) -> str:
        return f"{self.root}/{RESULTS}/run={self.run_id}"

    @property
    def output(self) -> str:
        return f"{self.root}/{KPI_OUTPUT}/run={self.run_id}"


def _tables_root(root: str) -> str:
    return f"{root.rstrip('/')}/tables"


def table_paths(root: str) -> dict[str, str]:
    """The keyed tables below ``root``."""
    return {name: f"{_tables_root(root)}/{name}" for name in KEYS}


def read_verdicts(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    """source_key, status, reason, result_key and output_prefix of the files of a run."""
    paths = RunPaths(root.rstrip("/"), run_id)
    return spark.read.schema(_VERDICT_SCHEMA).json(paths.verdicts)


def _named_files(
    spark: SparkSession, arrivals: Sequence[Arrival], root: str, unit: str
) -> DataFrame:
    prefix = plain_path(absolute(spark, root)) + "/"
    keys = [plain_path(a.path)[len(prefix) :] for a in arrivals]
    if unit == "directory":
        keys = [key.rpartition("/")[0] for key in keys]
    rows = [(key, *a) for key, a in zip(keys, arrivals, strict=True)]
    return spark.createDataFrame(rows, _FILE_SCHEMA)


def _arrivals(spark: SparkSession, files: Sequence[str | Arrival], root: str) -> list[Arrival]:
    """The files that are there, as the versions they are now; all must lie below ``root``."""
    prefix = plain_path(absolute(spark, root)) + "/"
    found = []
    for file in files:
        path = absolute(spark, file.path if isinstance(file, Arrival) else file)
        if not plain_path(path).startswith(prefix):
            raise ValueError(f"{path} does not lie below {root}")
        found.append(file if isinstance(file, Arrival) else arrival(spark, path))
    return [a for a in found if a]


def _good_plays(plays: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Plays of the files that passed; mostly there is nothing to take out."""
    failed = verdicts.where("status = 'FAILED'").select("source_key")
    size = failed.agg(F.sum(F.octet_length("source_key") + 64).alias("bytes")).first().bytes
    if size is None:
        return plays
    return plays.join(sized(failed, size <= BROADCAST_BYTES), "source_key", "left_anti")


def _twice_ranked(outputs: dict[str, DataFrame]) -> DataFrame:
    """(source_key, reason) of files whose own results hold a key of some table twice."""
    found = []
    for name, keys in KEYS.items():
        values = [F.concat(F.lit(f"{k}="), F.col(k).cast("string")) for k in keys]
        key = F.concat_ws(", ", F.lit(f"table={name}"), *values)
        found.append(outputs[name].select("source_key", key.alias("key")))
    twice = found[0].unionByName(found[1]).unionByName(found[2]).groupBy("source_key", "key").count()
    reason = F.concat(F.lit("Results hold a key more than once: "), F.min("key"))
    return twice.where("count > 1").groupBy("source_key").agg(reason.alias("twice"))


def read_tables(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """The three tables as one version has them, by default the latest; none before the first load.

    All are of the same version, however many loads are committed while they are read.
    """
    tables_root = _tables_root(root)
    found = latest(spark, tables_root) if version is None else snapshot(spark, tables_root, version)
    return {name: found.read(spark, name) for name in KEYS if name in found.schemas}


def load_tables(
    spark: SparkSession,
    outputs: dict[str, DataFrame],
    arrivals: DataFrame,
    root: str,
    mode: str = "replace",
    on_duplicate: str = "error",
    load: str | None = None,
    filing: dict[str, str] | None = None,
) -> dict[str, str]:
    """Put the result tables of a run into the keyed tables, all three by one commit.

    The results are per file; where files share a key (with ``mode='replace_group'``: a
    group), the file that arrived last (see ``arrivals``: source_key, arrived_at) counts, as
    if they had been loaded one by one. Files that are not in ``arrivals`` stay out. A
    track under two names can hold one rank twice: that is an error, or with
    ``on_duplicate='last'`` the row with the greatest other columns is kept.

    Every table's new state is written first. Readers see all of them from the commit of the
    next version on, and none before. When another load was committed meanwhile, the states are
    written again on what it left, if it touched the same days. A ``load`` that some version
    holds is not done again. ``filing`` (name to folder) is filing work that the commit adds.
    """
    if mode not in ("replace", "replace_group"):
        raise ValueError(f"mode must be 'replace' or 'replace_group', not {mode!r}")
    targets = table_paths(root)
    work = f"{root.rstrip('/')}/tmp/loads/{uuid.uuid4().hex}"
    ready: dict[str, DataFrame] = {}

    def prepare(name: str) -> None:
        keys, group = KEYS[name], _GROUPS[name]
        results = outputs[name].join(arrivals, "source_key")
        rows = latest_per_key(results, group if mode == "replace_group" else keys, ARRIVAL)
        rows = rows.drop(*ARRIVAL)
        if name == "top_songs_per_genre":
            rows = song_key_columns(rows)
        others = sorted(set(rows.columns) - set(keys))
        rows = one_row_per_key(written(rows, f"{work}/{name}"), keys, on_duplicate, others)
        ready[name] = written(rows, f"{work}/{name}-once") if on_duplicate == "last" else rows

    def stage(base: Snapshot) -> dict[str, Change]:
        changes: dict[str, Change] = {}

        def one(name: str) -> None:
            unversioned = None
            if name not in base.schemas and any_match(spark, f"{targets[name]}/date=*"):
                unversioned = read_keyed(spark, targets[name])
            replaced = _GROUPS[name] if mode == "replace_group" else None
            changes[name] = stage_state(
                base, name, ready[name], KEYS[name], replaced=replaced, unversioned=unversioned
            )

        side_by_side(spark, [partial(one, name) for name in KEYS])
        return changes

    try:
        side_by_side(spark, [partial(prepare, name) for name in KEYS])
        update(spark, _tables_root(root), stage, load, filing)
    finally:
        delete(spark, work)
    return targets


def _write_results(spark: SparkSession, paths: RunPaths) -> None:
    """The verdict of every file as an object of its own, where its ``result_key`` says."""
    verdicts = read_verdicts(spark, paths.root, paths.run_id)
    content = F.to_json(F.struct(*verdicts.columns), {"ignoreNullFields": "false"})
    write_objects(verdicts.select(F.col("result_key").alias("key"), content.alias("content")), paths.root)


def _plan_filing(spark: SparkSession, paths: RunPaths, unit: str) -> None:
    """Write where every file of the run goes: archive or quarantine."""
    key = F.col("source_key")
    name = F.substring_index("path", "/", -1)
    if unit == "directory":
        key = F.concat(key, F.lit("/"), name)
    files = spark.read.schema(_FILE_SCHEMA).parquet(paths.files)
    verdicts = read_verdicts(spark, paths.root, paths.run_id).select("source_key", "status")
    moves = files.join(verdicts, "source_key").select(
        key.alias("source"), "length", "modified", target_key(key, F.col("status")).alias("target")
    )
    moves.write.mode("overwrite").parquet(paths.filing)


_FILING_SCHEMA = "source string, length bigint, modified bigint, target string"


def finish_filing(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> dict[str, int]:
    """Move the files that loads have filed and that still lie in the inbox; gives counts of them.

    A file counts as filed from the commit of its load on; here its bytes follow, moved by
    tasks. The work of a load is done with the commit that takes it off the list, and one that
    dies before is repeated, which moves only what is left. ``names`` limits it to some loads.
    """
    root = root.rstrip("/")
    open_filing = latest(spark, _tables_root(root)).filing
    counts: Counter[str] = Counter()
    for name, folder in open_filing.items():
        if names is not None and name not in names:
            continue
        counts += Counter(move_in_tasks(spark.read.schema(_FILING_SCHEMA).parquet(folder), root))
        update(spark, _tables_root(root), lambda base: {}, filing={name: None})
        delete(spark, folder)
    return dict(counts)


def _file_away(spark: SparkSession, paths: RunPaths, unit: str) -> None:
    """Move every file of the run to the archive or the quarantine."""
    tables_root = _tables_root(paths.root)
    if paths.run_id not in latest(spark, tables_root).filing:
        _plan_filing(spark, paths, unit)  # the load was done without filing
        update(spark, tables_root, lambda base: {}, filing={paths.run_id: paths.filing})
    finish_filing(spark, paths.root, [paths.run_id])


def _load_id(run_id: str, given: Sequence[Arrival]) -> str:
    """A run over these versions of these files."""
    names = "\n".join(sorted(f"{plain_path(a.path)} {a.length} {a.modified}" for a in given))
    return f"{run_id}-{hashlib.md5(names.encode(), usedforsecurity=False).hexdigest()}"


def run_files(
    spark: SparkSession,
    files: Sequence[str | Arrival],
    songs: DataFrame,
    root: str,
    run_id: str,
    unit: str = "file",
    sample_rows: int | None = None,
    formats: Sequence[str] = (),
    mode: str = "replace",
    on_duplicate: str = "error",
    move_files: bool = True,
    infer_times: bool = True,
) -> dict[str, str]:
    """Check the files, load the KPIs of the good ones and file all of them away.

    The KPIs are those of each single file (``unit='directory'``: of each folder of part
    files). A file whose own results hold a key twice fails alone, the others are loaded;
    ``on_duplicate='last'`` loads it with the greatest of such rows. Times that neither the
    standard form nor ``formats`` reads are read in the layout that fits most of their file's
    (``in_file_layouts``), unless ``infer_times`` is off. Gives the paths of the keyed tables.
    """
    root = root.rstrip("/")
    paths = RunPaths(root, run_id)
    given = _arrivals(spark, files, root)
    named = _named_files(spark, given, root, unit)
    if exists(spark, paths.done) or exists(spark, paths.loaded):
        done = _named_files(spark, [], root, unit)
        if exists(spark, paths.files):
            done = spark.read.schema(_FILE_SCHEMA).parquet(paths.files)
        strangers = named.join(done, ["path", "length", "modified"], "left_anti").head(1)
        if strangers:
            raise ValueError(f"run {run_id} was already done without {strangers[0].path}")
    else:
        named = written(named, paths.files)
        touch(spark, paths.open)
        inspection = inspect_files(spark, [a.path for a in given], root, unit, f"{paths.work}/inspection")
        plays = land_plays(spark, inspection, root, f"{paths.work}/plays", unit, formats=formats)
        if infer_times:
            plays = in_file_layouts(plays, f"{paths.work}/layouts")
        verdicts = validate_files(
            plays,
            named,
            inspection,
            sample_rows=sample_rows,
            formats=formats,
            work=f"{paths.work}/profile",
        )
        verdicts = written(verdicts, f"{paths.work}/checked")
        single = {row.source_key for row in named.select("source_key").distinct().limit(2).collect()}
        place = f"{root}/{KPI_OUTPUT}/{single.pop()}" if len(single) == 1 else paths.output
        outputs = write_frames(_good_plays(plays, verdicts), songs, place, by=["source_key"])
        if on_duplicate == "error":
            verdicts = _with_failures(verdicts, _twice_ranked(outputs))
        key = F.col("source_key")
        prefix = output_prefix(key) if place != paths.output else F.lit(place[len(root) + 1 :])
        (
            verdicts.withColumns({"result_key": result_key(key), "output_prefix": prefix})
            .write.mode("overwrite")
            .json(paths.verdicts)
        )
        passed = read_verdicts(spark, root, run_id).where("status = 'PASSED'").select("source_key")
        arrivals = inspection.groupBy("source_key").agg(F.max("arrived_at").alias("arrived_at"))
        filing = None
        if move_files:
            _plan_filing(spark, paths, unit)
            filing = {run_id: paths.filing}
        load_tables(
            spark,
            outputs,
            arrivals.join(passed, "source_key"),
            root,
            mode,
            on_duplicate,
            _load_id(run_id, given),
            filing,
        )
        _write_results(spark, paths)
        touch(spark, paths.loaded)
    delete(spark, paths.work)
    if move_files:
        if exists(spark, paths.files):
            _file_away(spark, paths, unit)
        touch(spark, paths.done)
        delete(spark, paths.open)
        delete(spark, paths.files)
        delete(spark, paths.loaded)
    return table_paths(root)


def _with_failures(verdicts: DataFrame, failed: DataFrame) -> DataFrame:
    """``verdicts`` where the files in ``failed`` (source_key, twice) fail too."""
    return verdicts.join(failed, "source_key", "left").select(
        "source_key",
        F.when(F.col("twice").isNotNull(), "FAILED").otherwise(F.col("status")).alias("status"),
        F.coalesce("twice", "reason").alias("reason"),
    )


def run_inbox(
    spark: SparkSession, songs: DataFrame, root: str, run_id: str, **options
) -> dict[str, str]:
    """Run over everything that lies in the inbox; what is filed but not moved yet is moved first."""
    root = root.rstrip("/")
    finish_filing(spark, root)
    arrived = list_arrivals(spark, f"{root}/{INBOX}")
    return run_files(spark, arrived, songs, root, run_id, **options) if arrived else table_paths(root)


def finish_open_runs(spark: SparkSession, songs: DataFrame, root: str, **options) -> None:
    """Repeat the runs that began and did not get through, with what they still have to do.

    Needed after a death only. Runs are open from the time that their list of files is
    written; one that died before left its files in the inbox.
    """
    root = root.rstrip("/")
    for mark in list_arrivals(spark, f"{root}/{OPEN_RUNS}"):
        paths = RunPaths(root, plain_path(mark.path).rpartition("/")[2])
        rows = spark.read.schema(_FILE_SCHEMA).parquet(paths.files).select(*Arrival._fields).collect()
        given = [Arrival(*row) for row in rows]
        if not exists(spark, paths.loaded):
            given = [now for a in given if (now := arrival(spark, a.path))]
        if given:
            run_files(spark, given, songs, root, paths.run_id, **options)
        else:
            delete(spark, paths.open)
