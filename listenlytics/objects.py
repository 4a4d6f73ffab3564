"""Files moved and small objects written by tasks, so that the driver handles none of them.

Tasks reach the storage through pyarrow, which knows local and shared file systems, HDFS and
the large object stores. For a store that it does not know, the driver does the work through
Spark's own file system, some files at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from .files import Arrival, folder_names, for_each, list_arrivals, move, qualified, write_text

FILES_PER_TASK = 500


def known_uri(spark: SparkSession, root: str) -> str | None:
    """The root as pyarrow names it, None where pyarrow does not know its store."""
    scheme, _, rest = qualified(spark, root).partition(":")
    uri = f"{scheme}://{rest.removeprefix('//')}" if scheme != "file" else f"file:///{rest.lstrip('/')}"
    try:
        pafs.FileSystem.from_uri(uri)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ValueError):
        return None
    return uri


def _in_tasks(rows: DataFrame, uri: str, start: Callable) -> dict[str, int]:
    """Counts of what ``start(file_system, base)`` says of each row (a tuple)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow
        import pyarrow.fs

        file_system, base = pyarrow.fs.FileSystem.from_uri(uri)
        one = start(file_system, base.rstrip("/"))
        for batch in batches:
            said = [one(*row) for row in zip(*(column.to_pylist() for column in batch.columns), strict=True)]
            yield pyarrow.RecordBatch.from_arrays([pyarrow.array(said, pyarrow.string())], names=["said"])

    n_tasks = max(1, -(-rows.count() // FILES_PER_TASK))
    dealt = rows.repartition(n_tasks) if n_tasks > 1 else rows.coalesce(1)
    return {row["said"]: row["count"] for row in dealt.mapInArrow(run, "said string").groupBy("said").count().collect()}


ARRIVALS = "path string, length bigint, modified bigint"


def look(spark: SparkSession, root: str, folder: str) -> DataFrame:
    """(path, length, modified) of all visible files below ``root``/``folder``, listed by tasks.

    Each folder that lies directly in it is a prefix that one task walks through; the files
    beside them are another. An absent folder is empty. HDFS, whose times pyarrow gives in
    whole seconds only, and stores that pyarrow does not know are listed by the driver.
    """
    uri = known_uri(spark, root)
    if uri is None or not uri.startswith(("file:", "s3:", "gs:", "abfs")):
        return spark.createDataFrame(list_arrivals(spark, f"{root}/{folder}"), ARRIVALS)
    whole = qualified(spark, root).rstrip("/")
    prefixes = [(name,) for name in ["", *folder_names(spark, f"{root}/{folder}")] if not name.startswith(("_", "."))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow
        import pyarrow.fs

        file_system, base = pyarrow.fs.FileSystem.from_uri(uri)
        above = f"{base.rstrip('/')}/{folder}"
        for batch in batches:
            for prefix in batch.column(0).to_pylist():
                place = f"{above}/{prefix}".rstrip("/")
                kind = file_system.get_file_info(place).type
                if prefix and kind != pyarrow.fs.FileType.Directory:
                    continue  # a file of the first level, or one that has just been moved
                selector = pyarrow.fs.FileSelector(place, allow_not_found=True, recursive=bool(prefix))
                found = [
                    (info.path[len(above) + 1 :], info.size, info.mtime_ns // 10**6)
                    for info in file_system.get_file_info(selector)
                    if info.type == pyarrow.fs.FileType.File
                ]
                found = [f for f in found if not any(n.startswith(("_", ".")) for n in f[0].split("/"))]
                yield pyarrow.RecordBatch.from_arrays(
                    [
                        pyarrow.array([f"{whole}/{folder}/{name}" for name, _, _ in found], pyarrow.string()),
                        pyarrow.array([size for _, size, _ in found], pyarrow.int64()),
                        pyarrow.array([at for _, _, at in found], pyarrow.int64()),
                    ],
                    names=["path", "length", "modified"],
                )

    listed = spark.createDataFrame(prefixes, "prefix string").repartition(max(1, min(len(prefixes), 1000)))
    return listed.mapInArrow(run, ARRIVALS)


def move_files(moves: DataFrame, root: str) -> dict[str, int]:
    """Move files below ``root``: (source, length, modified, target), names relative to it.

    Gives how many were ``moved``, were ``gone`` already or had a ``newer`` version in their
    place, which stays. A task that is repeated finds its files gone. An older file at the
    target is replaced.
    """
    spark = moves.sparkSession
    moves = moves.select("source", "length", "modified", "target")
    uri = known_uri(spark, root)
    if uri is None:

        def one(row) -> None:
            move(spark, Arrival(f"{root}/{row.source}", row.length, row.modified), f"{root}/{row.target}")

        for_each(one, moves.toLocalIterator())
        return {"moved": moves.count()}

    def start(file_system, base: str):
        import pyarrow.fs

        absent = pyarrow.fs.FileType.NotFound
        made = set()

        def move_one(source: str, length: int, modified: int, target: str) -> str:
            found = file_system.get_file_info(f"{base}/{source}")
            if found.type == absent:
                return "gone"
            exact = found.mtime_ns % 10**9 != 0  # some stores keep whole seconds only
            unit = 10**6 if exact else 10**9
            if found.size != length or found.mtime_ns // unit != modified * 10**6 // unit:
                return "newer"
            path = f"{base}/{target}"
            folder = path.rpartition("/")[0]
            if folder not in made:
                file_system.create_dir(folder, recursive=True)
                made.add(folder)
            if file_system.get_file_info(path).type != absent:
                file_system.delete_file(path)
            file_system.move(f"{base}/{source}", path)
            return "moved"

        return move_one

    return _in_tasks(moves, uri, start)


def write_objects(objects: DataFrame, root: str) -> None:
    """Write each row (key, content) as an object of its own below ``root``, replacing an older one.

    An object is written beside its place and moved there, so that none is seen in part.
    """
    spark = objects.sparkSession
    objects = objects.select("key", "content")
    uri = known_uri(spark, root)
    if uri is None:
        for_each(lambda row: write_text(spark, f"{root}/{row.key}", row.content), objects.toLocalIterator())
        return

    def start(file_system, base: str):
        import uuid

        def write_one(key: str, content: str) -> str:
            folder, _, name = f"{base}/{key}".rpartition("/")
            file_system.create_dir(folder, recursive=True)
            beside = f"{folder}/_{uuid.uuid4().hex}"
            with file_system.open_output_stream(beside) as stream:
                stream.write(content.encode())
            file_system.move(beside, f"{folder}/{name}")
            return "written"

        return write_one

    _in_tasks(objects, uri, start)
