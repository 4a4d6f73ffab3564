"""CSV records that go over several lines, from files that are still read in blocks.

Whether a line starts inside a quoted field depends on all lines before it. But what a line
does to that state is known from the line alone: it keeps it, turns it round, or sets it.
Such steps can be put together in any grouping, so the state is followed within each block
of a file for both states that the block may start in, then over the few blocks of a file.
Lines that belong to one record are joined again, also across blocks.

Only files in which some line leaves a field open come here (``leaves_open``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..files import literal

#: Longest stretch of blocks (in characters) in which no record starts.
MAX_RECORD_CHARS = 64 * 1024 * 1024

_OUTSIDE, _INSIDE, _CLOSED = 0, 1, 2


def _ends_inside(line: Column, starts_inside: bool) -> Column:
    """Whether the end of a line lies in a quoted field.

    A quote opens a field only as its first character, and two quotes in a field are one.
    """

    def step(state: Column, piece: Column) -> Column:
        opens = (state == _CLOSED) & (piece == "") | (state != _INSIDE) & F.endswith(piece, F.lit(","))
        return F.when(state == _INSIDE, _CLOSED).when(opens, _INSIDE).otherwise(_OUTSIDE)

    text = line if starts_inside else F.concat(F.lit(","), line)
    pieces = F.split(text, '"', -1)
    before_quotes = F.slice(pieces, 1, F.array_size(pieces) - 1)
    start = F.lit(_INSIDE if starts_inside else _OUTSIDE)
    return F.when(F.contains(line, F.lit('"')), F.aggregate(before_quotes, start, step) == _INSIDE).otherwise(
        F.lit(starts_inside)
    )


def leaves_open(line: Column) -> Column:
    """Whether a line that starts a record leaves a quoted field open."""
    return _ends_inside(line, False)


def _with_states(steps: DataFrame, keys: Sequence[str], order: str, outside: str, inside: str) -> DataFrame:
    """``steps`` with the state before each: from_outside and from_inside, by the state before the first.

    ``outside`` and ``inside`` name what a step makes of either state (true: inside).
    """
    before = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col(outside) & ~F.col(inside)
    sets = F.col(outside) == F.col(inside)
    counted = steps.withColumn("_turns", F.coalesce(F.sum(turns.cast("int")).over(before), F.lit(0)))
    last_set = F.last(F.when(sets, F.struct(F.col(outside).alias("to"), "_turns")), ignorenulls=True)
    counted = counted.withColumn("_set", last_set.over(before))
    turned = (F.col("_turns") - F.coalesce("_set._turns", F.lit(0))) % 2 == 1
    return counted.withColumns(
        {
            "from_outside": F.coalesce("_set.to", F.lit(False)) != turned,
            "from_inside": F.coalesce("_set.to", F.lit(True)) != turned,
        }
    ).drop("_turns", "_set")


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All lines with their place, and whether their record starts in this block for either start of it."""
    lines = spark.read.text([literal(path) for path in paths]).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    steps = lines.withColumns(
        {"outside": _ends_inside(F.col("value"), False), "inside": _ends_inside(F.col("value"), True)}
    )
    return _with_states(steps, ["file_path", "block"], "row", "outside", "inside")


def _blocks(lines: DataFrame) -> DataFrame:
    """For each block: whether it starts inside a field, the record it goes on with, the header's row.

    Also ``unreadable``, for all blocks of a file alike: the last field is never closed, or
    no record starts for longer than ``MAX_RECORD_CHARS``.
    """

    def after(state: Column) -> Column:
        return F.when(state, F.col("inside")).otherwise(F.col("outside"))

    def last_start(state: Column) -> Column:
        return F.max(F.when(~state, F.col("row")))

    ends = F.struct(after(F.col("from_outside")).alias("outside"), after(F.col("from_inside")).alias("inside"))
    written = (F.col("block") == 0) & (F.trim("value") != "")
    blocks = (
        lines.groupBy("file_path", "block")
        .agg(
            F.max_by(ends, "row").alias("ends"),
            last_start(F.col("from_outside")).alias("start_outside"),
            last_start(F.col("from_inside")).alias("start_inside"),
            F.min(F.when(written, F.col("row"))).alias("header_row"),
            F.sum(F.char_length("value")).alias("chars"),
        )
        .select("*", "ends.outside", "ends.inside")
    )
    followed = _with_states(blocks, ["file_path"], "block", "outside", "inside")
    starts_inside = F.col("from_outside")  # a file starts outside
    start = F.when(starts_inside, F.col("start_inside")).otherwise(F.col("start_outside"))
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file_path")
    place = F.when(F.col("start").isNotNull(), F.struct("block", F.col("start").alias("row")))
    unclosed = F.max_by(after(starts_inside), "block").over(whole)
    endless = F.sum(F.when(F.col("start").isNull(), F.col("chars"))).over(whole) > MAX_RECORD_CHARS
    return followed.withColumn("start", start).select(
        "file_path",
        "block",
        starts_inside.alias("starts_inside"),
        F.last(place, ignorenulls=True).over(before).alias("carried"),
        "header_row",
        (unclosed | F.coalesce(endless, F.lit(False))).alias("unreadable"),
    )


def read_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Records of CSV files: file_path, block and row of their first line, value, unreadable.

    The header is left out, and so are blank lines between records. Lines of a record are
    joined by a line feed, whatever ended them in the file. A file with a field that is never
    closed, or with a record longer than ``MAX_RECORD_CHARS``, gives one row for each of its
    blocks, which is ``unreadable`` and has no value. A block's lines are put in order by one
    task (``spark.sql.files.maxPartitionBytes``), no task sees more of a file.
    """
    lines = _lines(spark, paths)
    blocks = _blocks(lines)
    inside = F.when(F.col("starts_inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    up_to_here = Window.partitionBy("file_path", "block").orderBy("row")
    own_start = F.last(F.when(~F.col("is_inside"), F.col("row")), ignorenulls=True).over(up_to_here)
    first = F.coalesce(F.when(F.col("own").isNotNull(), F.struct("block", F.col("own").alias("row"))), "carried")
    placed = (
        lines.join(blocks.where(~F.col("unreadable")), ["file_path", "block"])
        .withColumn("is_inside", inside)
        .withColumn("own", own_start)
        .where(F.col("header_row").isNull() | (F.col("row") != F.col("header_row")))
        .where(F.col("is_inside") | (F.trim("value") != ""))
        .select("file_path", first.alias("first"), "block", "row", "value")
    )
    pieces = F.array_sort(F.collect_list(F.struct("block", "row", "value")))
    records = placed.groupBy("file_path", F.col("first.block").alias("block"), F.col("first.row").alias("row")).agg(
        F.array_join(F.transform(pieces, lambda piece: piece["value"]), "\n").alias("value")
    )
    refused = blocks.where(F.col("unreadable")).select(
        "file_path", "block", F.lit(0).cast("bigint").alias("row"), F.lit(None).cast("string").alias("value")
    )
    both = records.withColumn("unreadable", F.lit(False)).unionByName(refused.withColumn("unreadable", F.lit(True)))
    # the rows of a block stay in order, as in a plain scan
    return both.repartition("file_path", "block").sortWithinPartitions("file_path", "block", "row")
