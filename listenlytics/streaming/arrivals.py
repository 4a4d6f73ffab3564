"""File arrivals as a stream.

Exact distinct counts and ranks cannot be kept on a streaming frame, and each file is a
unit of its own, so the work runs in ``foreachBatch``. Spark's file source remembers names,
so a file sent again under its name would never be seen; here a ticking source drives the
batches, tasks list the inbox once for each batch, and the identity of an arrival is its path,
length and modification time. A file that is still being written changes these: with ``settle``
only what two looks at the inbox saw alike is taken.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..files import Arrival, in_portions
from ..objects import look
from ..operators.routing import INBOX
from ..operators.upsert import upsert_by_key
from ..plans.run import finish_filing, finish_open_runs, run_files
from ..session import new_work_folder
from ..staging import written


def arrivals_id(arrivals: Sequence[Arrival]) -> str:
    """A run id that stands for these versions of these files."""
    names = "\n".join(f"{a.path} {a.length} {a.modified}" for a in arrivals)
    return f"arrivals-{hashlib.md5(names.encode(), usedforsecurity=False).hexdigest()}"


def settled(spark: SparkSession, root: str, settle: float = 0) -> DataFrame:
    """(path, length, modified) of the files in the inbox that may be taken.

    With ``settle`` the inbox is looked at twice, so many seconds apart, and files that came or
    changed in between are left for a later time.
    """
    first = look(spark, root, INBOX)
    if not settle:
        return first
    first = written(first, new_work_folder(spark, "look"))
    time.sleep(settle)
    return look(spark, root, INBOX).join(first, ["path", "length", "modified"], "left_semi")


def run_stream(
    spark: SparkSession,
    songs: Callable[[], DataFrame],
    root: str,
    checkpoint: str,
    max_files_per_trigger: int | None = 1,
    available_now: bool = True,
    every: str = "10 seconds",
    unit: str = "file",
    settle: float = 0,
    **options,
) -> StreamingQuery:
    """Runs over the files that arrive below ``raw/streams``, in the order they arrive.

    Each micro-batch lists the inbox once and takes what waits there in portions of
    ``max_files_per_trigger`` files, each portion a run of its own; larger portions give the
    same tables with fewer jobs. A file that is sent again runs again. ``songs`` is called for
    each portion, so a renewed catalogue takes effect. A run that died is finished first, before
    the inbox is listed. Folders of part files (``unit='directory'``) must arrive whole, so the
    files of a run cannot be limited then. With ``available_now`` the query ends when what
    waits is done, else it looks again ``every`` so often. An absent inbox is an empty one.
    Writers that do not put files in place as a whole need ``settle``, the seconds that a file
    must stay as it is; one that still grows is read later, once and whole.
    """
    if unit == "directory" and max_files_per_trigger:
        raise ValueError("unit='directory' needs max_files_per_trigger=None")
    root = root.rstrip("/")

    def sweep(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        finish_open_runs(session, songs(), root, unit=unit, **options)
        finish_filing(session, root)
        found = written(settled(session, root, settle), new_work_folder(session, "waiting"))
        in_order = found.orderBy("modified", "path").toLocalIterator(prefetchPartitions=True)
        waiting = (Arrival(*row) for row in in_order)
        for portion in in_portions(waiting, max_files_per_trigger or max(1, found.count())):
            run_files(session, portion, songs(), root, arrivals_id(portion), unit=unit, **options)

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    writer = ticks.writeStream.foreachBatch(sweep).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.trigger(**trigger).start()


def stream_into_table(
    plays: DataFrame,
    results: Callable[[DataFrame], DataFrame],
    target: str,
    keys: Sequence[str],
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Upsert the ``results`` of every micro-batch of ``plays``, a streaming frame.

    The unit is the micro-batch; one that is replayed puts the same rows again.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        upsert_by_key(target, results(batch), keys)

    writer = plays.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
