"""Several keyed tables under one version, changed by one atomic commit.

    <tables>/<name>/state=<id>/<partition>=<value>/   rows; a state is written once and never changed
    <tables>__versions/v000000007.json                which state each partition of each table is in

The version with the greatest number counts. A commit is the creation of the next number's
file, which only one writer can do; a reader that has read one version keeps seeing the
states it names. A writer that dies before its commit leaves states that no version names.

A version also names the loads it holds, so that one is not done twice, and the folders of
filing work (files that are loaded and still to be moved), which thus counts with the load.
"""

from __future__ import annotations

import json
import os
import re
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..files import create_once, delete, exists, folder_names, modified_at, read_text

KEPT_LOADS = 1000
ATTEMPTS = 20


class ConflictError(RuntimeError):
    """Another writer has committed the next version."""


@dataclass(frozen=True)
class Change:
    """New states of some partitions of a table; ``folders`` are names like date=2024-01-15."""

    schema: str
    state: str
    folders: tuple[str, ...]


@dataclass(frozen=True)
class Snapshot:
    """One version: for each table its schema and, for each partition folder, its state."""

    tables_root: str
    version: int = 0
    schemas: dict[str, str] = field(default_factory=dict)
    states: dict[str, dict[str, str]] = field(default_factory=dict)
    loads: tuple[str, ...] = ()
    filing: dict[str, str] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str, folders: Sequence[str] | None = None) -> DataFrame | None:
        """The table in this version, or only some of its partitions; None where it has never been written."""
        if name not in self.schemas:
            return None
        schema = T.StructType.fromJson(json.loads(self.schemas[name]))
        mine = self.states[name]
        wanted = [f for f in mine if folders is None or f in set(folders)]
        if not wanted:
            return spark.createDataFrame([], schema)
        base = f"{self.tables_root}/{name}"
        paths = [f"{base}/state={mine[folder]}/{folder}" for folder in sorted(wanted)]
        return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.names)

    def changed(self, changes: dict[str, Change], load: str | None, filing: dict[str, str | None]) -> Snapshot:
        schemas, states = dict(self.schemas), dict(self.states)
        for name, change in changes.items():
            schemas[name] = change.schema
            states[name] = {**states.get(name, {}), **dict.fromkeys(change.folders, change.state)}
        open_filing = {k: v for k, v in {**self.filing, **filing}.items() if v}
        loads = (*self.loads, load)[-KEPT_LOADS:] if load else self.loads
        return replace(
            self, version=self.version + 1, schemas=schemas, states=states, loads=loads, filing=open_filing
        )

    def fits(self, newer: Snapshot, changes: dict[str, Change]) -> bool:
        """Whether ``changes`` made on this version hold on a newer one: their partitions are the same."""
        return all(
            self.states.get(name, {}).get(folder) == newer.states.get(name, {}).get(folder)
            for name, change in changes.items()
            for folder in change.folders
        )


def _versions(tables_root: str) -> str:
    return f"{tables_root.rstrip('/')}__versions"


def _file(tables_root: str, version: int) -> str:
    return f"{_versions(tables_root)}/v{version:09d}.json"


def latest(spark: SparkSession, tables_root: str) -> Snapshot:
    """The version that counts now; version 0 is that of no tables."""
    tables_root = tables_root.rstrip("/")
    names = [n for n in folder_names(spark, _versions(tables_root)) if n.startswith("v") and n.endswith(".json")]
    if not names:
        return Snapshot(tables_root)
    return snapshot(spark, tables_root, max(int(n[1:-5]) for n in names))


def snapshot(spark: SparkSession, tables_root: str, version: int) -> Snapshot:
    """A version by its number, as long as it is kept."""
    known = json.loads(read_text(spark, _file(tables_root, version)))
    return Snapshot(
        tables_root.rstrip("/"), known["version"], known["schemas"], known["states"], tuple(known["loads"]), known["filing"]
    )


def commit(
    spark: SparkSession,
    base: Snapshot,
    changes: dict[str, Change],
    load: str | None = None,
    filing: dict[str, str | None] | None = None,
) -> Snapshot:
    """Make ``base`` with the changes the next version; ConflictError if there is a next one already.

    ``filing`` adds folders of filing work by name, or ends them with None.
    """
    new = base.changed(changes, load, filing or {})
    content = {key: getattr(new, key) for key in ("version", "schemas", "states", "loads", "filing")}
    if not create_once(spark, _file(base.tables_root, new.version), json.dumps(content)):
        raise ConflictError(f"version {new.version} of {base.tables_root} was committed by another writer")
    return new


def update(
    spark: SparkSession,
    tables_root: str,
    stage: Callable[[Snapshot], dict[str, Change]],
    load: str | None = None,
    filing: dict[str, str | None] | None = None,
) -> Snapshot:
    """Stage changes on the latest version and commit them; again on a newer one where a writer was faster.

    Staged changes are kept if the newer version has the same states in their partitions.
    """
    base = latest(spark, tables_root)
    changes = None
    for _ in range(ATTEMPTS):
        if load and load in base.loads:
            return base
        if changes is None:
            changes = stage(base)
        try:
            return commit(spark, base, changes, load, filing)
        except ConflictError:
            newer = latest(spark, tables_root)
            if not base.fits(newer, changes):
                changes = None
            base = newer
    raise ConflictError(f"{tables_root} was changed by others {ATTEMPTS} times")


def _folder(partition: str, value: object) -> str | None:
    """The folder of a partition value; None for one whose name Spark may write in another way."""
    if value is None:
        return f"{partition}=__HIVE_DEFAULT_PARTITION__"
    return f"{partition}={value}" if re.match(r"[\w.-]+\Z", str(value)) else None


def stage_state(
    base: Snapshot,
    name: str,
    new: DataFrame,
    keys: Sequence[str],
    partition: str = "date",
    replaced: Sequence[str] | None = None,
    unversioned: DataFrame | None = None,
) -> Change:
    """Write the next state of the partitions that ``new`` touches, which no reader sees yet.

    ``new``, a written table, has one row for each of ``keys``; old rows with equal ``replaced``
    (by default the keys) go. ``unversioned`` are the rows of a table that no version holds so
    far; they all get a state. The touched partitions, which are folders in any case, come to
    the driver by name.
    """
    spark = new.sparkSession
    state = uuid.uuid4().hex
    folder = f"{base.tables_root}/{name}/state={state}"
    old = unversioned
    if name in base.schemas:
        values = [row[0] for row in new.select(partition).distinct().collect()]
        folders = [_folder(partition, value) for value in values]
        if None in folders:
            old = base.read(spark, name).join(new.select(partition).distinct(), partition, "left_semi")
        else:
            old = base.read(spark, name, folders)
    whole = new
    if old is not None:
        replaced = list(replaced or keys)
        kept = old.join(new.select(*replaced).distinct(), replaced, "left_anti")
        whole = kept.select(*new.columns).unionByName(new)
    whole.hint("rebalance", partition).write.partitionBy(partition).parquet(folder)
    # a partition column comes last in what Spark reads
    fields = [f for f in new.schema.fields if f.name != partition] + [new.schema[partition]]
    folders = tuple(f for f in folder_names(spark, folder) if "=" in f)
    return Change(T.StructType(fields).json(), state, folders)


def clean(spark: SparkSession, tables_root: str, keep: int = 10, older_than_ms: int = 24 * 3600 * 1000) -> int:
    """Delete versions before the last ``keep`` and states that no kept version names.

    States written less than ``older_than_ms`` ago stay, since a writer may be about to commit
    them. Gives the number of states deleted.
    """
    now = latest(spark, tables_root)
    first = max(1, now.version - keep + 1)
    kept = [snapshot(spark, tables_root, v) for v in range(first, now.version + 1) if exists(spark, _file(tables_root, v))]
    used = {(name, state) for s in kept for name, folders in s.states.items() for state in folders.values()}
    gone = 0
    for name in folder_names(spark, tables_root):
        for folder in folder_names(spark, f"{tables_root}/{name}"):
            path = f"{tables_root}/{name}/{folder}"
            unused = folder.startswith("state=") and (name, folder[6:]) not in used
            if unused and time.time() * 1000 - modified_at(spark, path) >= older_than_ms:
                delete(spark, path)
                gone += 1
    for version in folder_names(spark, _versions(tables_root)):
        if version.startswith("v") and version < os.path.basename(_file(tables_root, first)):
            delete(spark, f"{_versions(tables_root)}/{version}")
    return gone


def version_of(spark: SparkSession, target: str) -> tuple[Snapshot, str] | None:
    """The latest version that holds the table at ``target``, and its name there."""
    root, _, name = target.rstrip("/").rpartition("/")
    if not root or not exists(spark, _versions(root)):
        return None
    found = latest(spark, root)
    return (found, name) if name in found.schemas else None
