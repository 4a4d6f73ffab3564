"""Multi-part parquet tables."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..objects import known_uri

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def promoted(types: Sequence[T.DataType]) -> T.DataType:
    """The type that values of all ``types`` are read as.

    Whole numbers become the widest of them, with decimals a decimal, with floating numbers
    double; dates with times become times; what has nothing else in common becomes text.
    """
    kinds = {type(t) for t in types}
    if len({t.simpleString() for t in types}) == 1:
        return types[0]
    if kinds <= set(_WHOLE):
        return max(types, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, *_FLOATING, T.DecimalType}:
        if kinds & set(_FLOATING):
            return T.DoubleType()
        return T.DecimalType(38, max(t.scale for t in types if isinstance(t, T.DecimalType)))
    if kinds <= set(_TIMES):
        return max(types, key=lambda t: _TIMES.index(type(t)))
    return T.StringType()


def _footers(files: DataFrame) -> DataFrame:
    """(layout, paths): the columns that the footers tell, read by tasks, with the files that have them.

    A column without a type, as a part with nothing but nulls may have, is left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow
        import pyarrow.fs
        import pyarrow.parquet
        from pyspark.sql.pandas.types import from_arrow_type
        from pyspark.sql.types import StructField, StructType

        for batch in batches:
            layouts = []
            for path in batch.column(0).to_pylist():
                uri = "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path
                file_system, place = pyarrow.fs.FileSystem.from_uri(uri)
                footer = pyarrow.parquet.read_schema(place, filesystem=file_system)
                by_spark = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                fields = [
                    StructField(f.name, from_arrow_type(f.type, prefer_timestamp_ntz=True))
                    for f in footer
                    if not pyarrow.types.is_null(f.type)
                ]
                layouts.append(by_spark.decode() if by_spark else StructType(fields).json())
            yield pyarrow.RecordBatch.from_arrays([batch.column(0), pyarrow.array(layouts)], names=["path", "layout"])

    told = files.mapInArrow(run, "path string, layout string")
    return told.groupBy("layout").agg(F.sort_array(F.collect_list("path")).alias("paths"))


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """Every ``*.parquet`` file at any depth below ``path``, matched by column name.

    A column missing in some part is null there. Where parts differ in a column's type, it is
    read as the type that all of them are ``promoted`` to, which the footers tell before the
    scan; in a store that tasks cannot reach with pyarrow such parts raise. Spark raises when
    there is no file.
    """
    def reader(source: str):
        files = spark.read.format(source).option("recursiveFileLookup", True)
        return files.option("pathGlobFilter", "*.parquet")

    if known_uri(spark, path) is None:
        return reader("parquet").option("mergeSchema", True).load(path)
    layouts = [
        (T.StructType.fromJson(json.loads(row.layout)), row.paths)
        for row in _footers(reader("binaryFile").load(path).select("path")).collect()
    ]
    if not layouts:
        return reader("parquet").load(path)  # which raises
    types: dict[str, list[T.DataType]] = {}
    for layout, _ in layouts:
        for column in layout.fields:
            types.setdefault(column.name, []).append(column.dataType)
    kinds = {name: promoted(of_name) for name, of_name in types.items()}
    if all({t.simpleString() for t in of_name} == {kinds[name].simpleString()} for name, of_name in types.items()):
        return reader("parquet").schema(T.StructType([T.StructField(*item) for item in kinds.items()])).load(path)
    scans = []
    for layout, paths in sorted(layouts, key=lambda item: item[1]):
        part = spark.read.schema(layout).parquet(*paths)
        columns = [
            (F.col(f"`{name}`") if name in layout.names else F.lit(None)).cast(kind).alias(name)
            for name, kind in kinds.items()
        ]
        scans.append(part.select(*columns))
    return reduce(DataFrame.unionByName, scans)
