"""Metadata-only file operations through the Hadoop file system that Spark itself uses.

File names pass through the driver here, as they do in Spark's own file index and
commit protocol; file contents never do.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from itertools import islice
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

FILE_THREADS = 16
PORTION = 1000


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def any_match(spark: SparkSession, pattern: str) -> bool:
    fs, hadoop_pattern = _open(spark, pattern)
    return bool(fs.globStatus(hadoop_pattern))


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    fs, hadoop_path = _open(spark, path)
    fs.create(hadoop_path, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file with ``text``, replacing an older one."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file as a whole, unless there is one; of several writers one succeeds.

    The content is written beside it first. A store must rename without replacing in one step
    (as HDFS does); a file of this machine is linked, since its rename replaces.
    """
    fs, hadoop_path = _open(spark, path)
    if fs.exists(hadoop_path):
        return False
    beside = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
    write_text(spark, beside, text)
    try:
        if fs.getScheme() == "file":
            os.link(plain_path(beside), plain_path(path))
            return True
        options = spark._jvm.org.apache.hadoop.fs.Options
        none = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 0)
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            hadoop_path.toUri(), spark._jsc.hadoopConfiguration()
        )
        context.rename(_open(spark, beside)[1], hadoop_path, none)
        return True
    except (FileExistsError, Py4JJavaError):
        if not fs.exists(hadoop_path):
            raise
        return False
    finally:
        delete(spark, beside)


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """The names of what lies directly in a folder; none where it is absent."""
    fs, hadoop_path = _open(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    return sorted(entry.getPath().getName() for entry in fs.listStatus(hadoop_path))


def modified_at(spark: SparkSession, path: str) -> int:
    """When a file or folder was changed last, in milliseconds."""
    fs, hadoop_path = _open(spark, path)
    return fs.getFileStatus(hadoop_path).getModificationTime()


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; ``target`` must not be there."""
    fs, source_path = _open(spark, source)
    _, target_path = _open(spark, target)
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not move {source} to {target}")


class Arrival(NamedTuple):
    """One version of a file: sent again under its name, it is another arrival."""

    path: str
    length: int
    modified: int  # milliseconds


def list_arrivals(spark: SparkSession, folder: str) -> list[Arrival]:
    """All visible files below ``folder`` in the order they arrived, empty files included.

    Spark's own file scans skip zero-byte files, so they can only be found here.
    """
    fs, hadoop_path = _open(spark, folder)
    if not fs.exists(hadoop_path):
        return []
    found = []
    below = len(plain_path(folder)) + 1
    entries = fs.listFiles(hadoop_path, True)
    while entries.hasNext():
        entry = entries.next()
        path = entry.getPath().toString()
        if not any(name.startswith(("_", ".")) for name in plain_path(path)[below:].split("/")):
            found.append(Arrival(path, entry.getLen(), entry.getModificationTime()))
    return sorted(found, key=lambda a: (a.modified, a.path))


def list_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """All visible files below ``folder`` as (path, bytes), empty files included."""
    return sorted((a.path, a.length) for a in list_arrivals(spark, folder))


def arrival(spark: SparkSession, path: str) -> Arrival | None:
    """The version of a file that lies at ``path`` now."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return None
    status = fs.getFileStatus(hadoop_path)
    return Arrival(path, status.getLen(), status.getModificationTime())


def move(spark: SparkSession, source: Arrival, target: str) -> None:
    """Move one file, replacing an older one of the same name.

    A file that is gone was moved by an earlier attempt; another version that has
    arrived in its place stays.
    """
    if arrival(spark, source.path) != source:
        return
    fs, source_path = _open(spark, source.path)
    _, target_path = _open(spark, target)
    fs.mkdirs(target_path.getParent())
    if fs.exists(target_path):
        fs.delete(target_path, False)
    if not fs.rename(source_path, target_path):
        raise OSError(f"could not move {source.path} to {target}")


def in_portions(items: Iterable, size: int) -> Iterator[list]:
    """Lists of up to ``size`` items, the next one taken when it is asked for."""
    rest = iter(items)
    while portion := list(islice(rest, size)):
        yield portion


def for_each(action: Callable, items: Iterable) -> None:
    """Call ``action`` with every item, some at a time, holding no more than a portion of them."""
    with ThreadPoolExecutor(FILE_THREADS) as pool:
        for portion in in_portions(items, PORTION):
            for _ in pool.map(action, portion):
                pass


_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:/+"


def plain_path(path: str) -> str:
    """A path without its URI scheme, so that file:/x, file:///x and /x compare equal."""
    return re.sub(_SCHEME, "/", path).rstrip("/")


def absolute(spark: SparkSession, path: str) -> str:
    """A path as Spark names it: relative ones start at the file system's working folder."""
    if path.startswith("/") or re.match(_SCHEME, path):
        return path
    fs, hadoop_path = _open(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def qualified(spark: SparkSession, path: str) -> str:
    """A path with the scheme of its store."""
    fs, hadoop_path = _open(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def literal(path: str) -> str:
    """A path for Spark's readers that stands for this one file, whatever its name holds."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def without_scheme(path: Column) -> Column:
    """``plain_path`` as a column expression."""
    return F.regexp_replace(path, _SCHEME, "/")


def decoded(uri: Column) -> Column:
    """URI-encoded text, as ``_metadata.file_path`` is, in plain form."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def scanned_path(file_path: Column) -> Column:
    """The plain path of a ``_metadata.file_path``."""
    return decoded(without_scheme(file_path))


def source_key(path: Column, root: str, unit: str = "file") -> Column:
    """The key of a plain path relative to ``root``.

    ``unit='directory'`` gives all part files of one folder the folder's key.
    """
    key = F.substr(path, F.lit(len(plain_path(root)) + 2))
    return folder_of(key) if unit == "directory" else key


def folder_of(key: Column) -> Column:
    return F.regexp_replace(key, "/[^/]*$", "")
