"""The layout of a file's times, found by what reads most of them.

Times in the standard form need no layout. For the others every layout counts how many times
of a file it reads, in one aggregate over those rows only; the file then has the layout with
most, so the check and the KPIs read one text in one way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.plays import LANDED_ORDER
from ..staging import written
from .enrich import BROADCAST_BYTES, sized

_CLOCK = "[ H:mm[:ss]]"
_HALF_DAY = " h:mm[:ss] a"

#: Of layouts that read equally many times the first counts: month before day, as usual in such files.
TIME_LAYOUTS = (
    f"M/d/yyyy{_CLOCK}",
    f"d/M/yyyy{_CLOCK}",
    f"M/d/yyyy{_HALF_DAY}",
    f"d/M/yyyy{_HALF_DAY}",
    f"M-d-yyyy{_CLOCK}",
    f"d-M-yyyy{_CLOCK}",
    f"d.M.yyyy{_CLOCK}",
    f"yyyy/M/d{_CLOCK}",
    f"MMM d, yyyy{_CLOCK}",
    f"d MMM yyyy{_CLOCK}",
)


def file_layouts(plays: DataFrame, work: str, layouts: Sequence[str] = TIME_LAYOUTS) -> DataFrame:
    """(source_key, layout) of files with times that are not in the standard form, written to ``work``.

    ``plays`` have the ``date`` that ``land_plays`` found. ``layout`` is the place of the layout
    in the list; files of which no layout reads a time give no row.
    """
    odd = plays.where(F.col("date").isNull() & F.col("listen_time").isNotNull())
    reads = [F.count(F.try_to_timestamp("listen_time", F.lit(f))).alias(f"reads_{i}") for i, f in enumerate(layouts)]
    counted = odd.groupBy("source_key").agg(*reads)
    ranked = [F.struct(F.col(f"reads_{i}").alias("reads"), F.lit(-i).alias("place")) for i in range(len(layouts))]
    best = counted.select("source_key", F.array_max(F.array(*ranked)).alias("best"))
    return written(best.where("best.reads > 0").select("source_key", (-F.col("best.place")).alias("layout")), work)


def in_file_layouts(plays: DataFrame, work: str, layouts: Sequence[str] = TIME_LAYOUTS) -> DataFrame:
    """``plays`` whose times are in the standard form, where the layout of their file reads them.

    Their ``date`` is set too. Times that it does not read stay as they are, which fails the
    check. Landed plays get their ``row``, by which the check orders them. Where all times are in
    the standard form ``plays`` come back unchanged.
    """
    found = file_layouts(plays, work, layouts)
    size = found.agg(F.sum(F.octet_length("source_key") + 64).alias("bytes")).first().bytes
    if size is None:
        return plays
    chosen = found.groupBy("source_key").agg(F.first("layout").alias("_layout"))
    is_odd = F.col("date").isNull() & F.col("listen_time").isNotNull()
    attempts = (
        (is_odd & (F.col("_layout") == i), F.try_to_timestamp("listen_time", F.lit(layout)))
        for i, layout in enumerate(layouts)
    )
    time = reduce(lambda before, attempt: before.when(*attempt), attempts, F)
    if "row" not in plays.columns:
        plays = plays.withColumn("row", F.col(LANDED_ORDER[-1]))
    return (
        plays.join(sized(chosen, size <= BROADCAST_BYTES), "source_key", "left")
        .withColumn("_time", time)
        .withColumn("date", F.coalesce("date", F.col("_time").cast("date")))
        .withColumn("listen_time", F.coalesce(F.date_format("_time", "yyyy-MM-dd HH:mm:ss"), "listen_time"))
        .select(*plays.columns)
    )
