"""Play-log CSV files.

Files of one drop may differ in their headers, and one Spark CSV scan applies one
schema to all its files by position. So the headers are looked at first, in one text
scan that also finds bytes that are not UTF-8, and the files are then read with one
scan for each distinct header. ``land_plays`` does the CSV parsing once and keeps the
needed columns as parquet for the check and for every KPI. Files in which a quoted field
holds a line break are read record by record (``records``), by blocks as well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..files import absolute, decoded, folder_of, literal, plain_path, scanned_path, source_key
from ..functions import listen_date
from ..session import new_work_folder
from ..staging import written
from .records import leaves_open, read_records

# The columns of a play log.
PLAY_COLUMNS = ("user_id", "track_id", "listen_time")

# The order of the rows of a file: as read, and in the table that land_plays writes.
READ_ORDER = ("part", "block", "row")
LANDED_ORDER = ("part", "block", "_metadata.row_index")

# One CSV field after its comma: quoted with doubled quotes, or anything up to the next comma.
_FIELD = ',("(?:[^"]|"")*"|[^,]*)'


def _field_count(line: Column) -> Column:
    return F.regexp_count(F.concat(F.lit(","), line), F.lit(_FIELD))


def _header_names(line: Column) -> Column:
    fields = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_FIELD), F.lit(1))
    return F.transform(fields, lambda f: F.lower(F.trim(F.regexp_replace(f, '^"|"$', ""))))


def _missing_columns(names: Column) -> Column:
    return F.array_sort(F.array_except(F.lit(list(PLAY_COLUMNS)), names))


def inspect_files(
    spark: SparkSession,
    paths: Sequence[str],
    root: str,
    unit: str = "file",
    target: str | None = None,
) -> DataFrame:
    """One row for each file that holds any text, worked out once and kept at ``target``.

    Without a ``target`` the table lies in a new folder of the shared work space.

    Columns: source_key, path, file_path (as Spark's scans name it), arrived_at (modification
    time), missing (play columns the header lacks), header (its normalised names, null when
    some are missing), line_count (data lines), invalid_lines (lines that are not UTF-8) and
    broken_lines (lines that leave a quoted field open, each taken for itself: where there are
    none, every line is a record). Files without text give no row. A header is one line.

    The first line cannot be taken with an aggregate over texts, which Spark would sort
    for. Lines are instead counted by what they would mean as a header, with hashed
    counters only, and the few groups of a file then show what its first line was.
    """
    root = absolute(spark, root)
    lower = F.lower("value")
    named = reduce(or_, [F.contains(lower, F.lit(column)) for column in PLAY_COLUMNS])
    may_be_header = (F.col("block") == 0) & named
    kinds = (
        spark.read.text([literal(path) for path in paths])
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .withColumn("row", F.monotonically_increasing_id())
        .where(F.trim("value") != "")
        .withColumn("missing", F.when(may_be_header, _missing_columns(_header_names(F.col("value")))))
        .withColumn("header_line", F.when(F.array_size("missing") == 0, F.col("value")))
        .groupBy("file_path", "missing", "header_line")
        .agg(
            F.count("*").alias("lines"),
            F.count_if(~F.is_valid_utf8("value")).alias("invalid"),
            F.count_if(leaves_open(F.col("value"))).alias("broken"),
            F.min(F.when(F.col("block") == 0, F.col("row"))).alias("first_row"),
            F.max("modified").alias("arrived_at"),
        )
    )
    inspection = (
        kinds.groupBy("file_path")
        .agg(
            F.min_by(F.struct("missing", "header_line"), "first_row").alias("first"),
            (F.sum("lines") - 1).alias("line_count"),
            F.sum("invalid").alias("invalid_lines"),
            F.sum("broken").alias("broken_lines"),
            F.max("arrived_at").alias("arrived_at"),
        )
        .withColumn("path", scanned_path(F.col("file_path")))
        .select(
            source_key(F.col("path"), root, unit).alias("source_key"),
            "path",
            "file_path",
            "arrived_at",
            F.coalesce("first.missing", F.lit(sorted(PLAY_COLUMNS))).alias("missing"),
            _header_names(F.col("first.header_line")).alias("header"),
            "line_count",
            "invalid_lines",
            "broken_lines",
        )
    )
    return written(inspection, target or new_work_folder(spark, "inspection"))


def _row_key(file_path: Column, files: Sequence[Row], root: str, unit: str) -> Column:
    """The source_key of a row scanned from ``file_path``.

    It is worked out for every row, so what holds for all files is settled beforehand:
    where in their paths the key starts, and whether any path needs decoding.
    """
    sample = files[0]
    depth = sample.path.count("/") - plain_path(root).count("/")
    start = len(sample.file_path.rsplit("/", depth)[0]) + 1
    key = F.substr(file_path, F.lit(start + 1))
    if unit == "directory":
        key = folder_of(key)
    return decoded(key) if any("%" in file.file_path for file in files) else key


def _csv_names(header: Sequence[str], wanted: Sequence[str]) -> list[str]:
    """A column name for each field: its own at its first place if it is wanted."""
    names, seen = [], set()
    for position, name in enumerate(header):
        names.append(name if name in wanted and name not in seen else f"unused_{position}")
        seen.add(name)
    return names


def _read_layout(
    spark: SparkSession,
    header: Sequence[str],
    files: Sequence[Row],
    root: str,
    unit: str,
    keep: Sequence[str],
    broken: bool,
) -> DataFrame:
    """Rows of the files with this header; ``broken`` files are put together from their lines."""
    names = _csv_names(header, [*PLAY_COLUMNS, *keep])
    schema = ", ".join(f"`{name}` string" for name in [*names, "whole_line"])
    # quotes in a quoted field are doubled; whole_line is set where the number of fields
    # differs from the header, either way
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "whole_line", "escape": '"'}
    paths = [file.path for file in files]
    if broken:
        fields = F.from_csv("value", schema, options)
        rows = read_records(spark, paths).withColumn("fields", fields).select("*", "fields.*")
        file_path, block, row = F.col("file_path"), F.col("block"), F.col("row")
        file_name, unreadable = decoded(F.substring_index("file_path", "/", -1)), F.col("unreadable")
    else:
        reader = spark.read.schema(schema).options(header=True, enforceSchema=True, **options)
        rows = reader.csv([literal(path) for path in paths])
        file_path, block = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
        row, unreadable = F.monotonically_increasing_id(), F.lit(False)
        file_name = F.col("_metadata.file_name")
    overlong = F.col("whole_line").isNotNull() & (_field_count(F.col("whole_line")) > len(header))
    return rows.select(
        _row_key(file_path, files, root, unit).alias("source_key"),
        (file_name if unit == "directory" else F.lit("")).alias("part"),
        block.alias("block"),
        row.alias("row"),
        *PLAY_COLUMNS,
        *[(F.col(c) if c in header else F.lit(None).cast("string")).alias(c) for c in keep],
        overlong.alias("overlong"),
        unreadable.alias("unreadable"),
    )


def _no_plays(spark: SparkSession, keep: Sequence[str]) -> DataFrame:
    texts = ", ".join(f"`{c}` string" for c in [*PLAY_COLUMNS, *keep])
    return spark.createDataFrame(
        [],
        "source_key string, part string, block bigint, row bigint, "
        f"{texts}, overlong boolean, unreadable boolean",
    )


def read_plays(
    spark: SparkSession,
    inspection: DataFrame,
    root: str,
    unit: str = "file",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows of all inspected files whose header holds the play columns.

    Columns: source_key; part (for folders of part files), block and row, which give the
    order of the rows; the play columns and ``keep`` as text; overlong, whether the row has
    more fields than the header; unreadable, for a row that stands for a block of a file whose
    records cannot be told (``read_records``). The file names come to the driver once, where
    Spark's file index holds them in any case; the number of scans is the number of distinct
    headers, and one more for each header that also has files with broken lines.
    """
    root = absolute(spark, root)
    layouts: dict[tuple[tuple[str, ...], bool], list[Row]] = {}
    broken = (F.col("broken_lines") > 0).alias("broken")
    usable = inspection.where(F.col("header").isNotNull()).select("header", "path", "file_path", broken)
    for file in usable.collect():
        layouts.setdefault((tuple(file.header), file.broken), []).append(file)
    scans = [
        _read_layout(spark, header, files, root, unit, keep, broken)
        for (header, broken), files in sorted(layouts.items(), key=lambda layout: layout[0])
    ]
    return reduce(DataFrame.unionByName, scans) if scans else _no_plays(spark, keep)


def land_plays(
    spark: SparkSession,
    inspection: DataFrame,
    root: str,
    target: str,
    unit: str = "file",
    keep: Sequence[str] = (),
    formats: Sequence[str] = (),
) -> DataFrame:
    """Parse the CSV once into a narrow parquet table at ``target`` and read that.

    The table also holds the ``date``, so the KPIs need not parse times again. It has no
    ``row``: the rows of a block stay in order, see ``LANDED_ORDER``.
    """
    rows = read_plays(spark, inspection, root, unit, keep).drop("row")
    return written(rows.withColumn("date", listen_date(F.col("listen_time"), formats)), target)
