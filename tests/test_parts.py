"""Part files whose columns differ in type."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from listenlytics.sources import read_parts
from listenlytics.sources.parts import promoted


def put(folder, **tables):
    for name, table in tables.items():
        path = folder / f"{name}.parquet"
        path.parent.mkdir(parents=True, exist_ok=True)
        pq.write_table(pa.table(table), path)


def test_types_are_promoted(spark, tmp_path):
    put(tmp_path, a={"x": pa.array([1], pa.int32()), "s": ["a"]}, b={"x": pa.array([2**40], pa.int64()), "s": ["b"]})
    read = read_parts(spark, str(tmp_path))
    assert rows_of(read, "x", "s") == [(1, "a"), (2**40, "b")] and read.schema["x"].dataType == T.LongType()
    nulls = pa.array([None], pa.null())
    put(tmp_path / "deep", c={"x": nulls, "s": pa.array([3])}, d={"x": [1.5], "s": nulls, "only_here": [True]})
    read = read_parts(spark, str(tmp_path))
    assert [read.schema[c].dataType.simpleString() for c in ("x", "s", "only_here")] == ["double", "string", "boolean"]
    rows = {(1.0, "a", None), (2.0**40, "b", None), (None, "3", None), (1.5, None, True)}
    assert {(r.x, r.s, r.only_here) for r in read.collect()} == rows


def test_parts_of_spark_and_others_together(spark, tmp_path):
    spark.sql("SELECT 1 AS x, timestamp'2024-01-01 10:00:00' AS t, date'2024-01-01' AS d").write.parquet(f"{tmp_path}/a")
    spark.sql("SELECT 2L AS x, timestamp'2024-01-02 10:00:00' AS t, timestamp'2024-01-02 00:00:00' AS d").write.parquet(
        f"{tmp_path}/b"
    )
    read = read_parts(spark, str(tmp_path))
    assert [str(r) for r in read.selectExpr("string(x)", "string(t)", "string(d)").orderBy("x").collect()] == [
        "Row(x='1', t='2024-01-01 10:00:00', d='2024-01-01 00:00:00')",
        "Row(x='2', t='2024-01-02 10:00:00', d='2024-01-02 00:00:00')",
    ]


def test_equal_parts_are_one_scan(spark, tmp_path):
    put(tmp_path, a={"x": [1], "y": ["a"]}, b={"x": [2]})
    read = read_parts(spark, str(tmp_path))
    assert rows_of(read, "x", "y") == [(1, "a"), (2, None)]
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    with pytest.raises(AnalysisException):
        read_parts(spark, f"{tmp_path}/absent")


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ([T.ByteType(), T.LongType(), T.ShortType()], T.LongType()),
        ([T.LongType(), T.FloatType()], T.DoubleType()),
        ([T.DecimalType(10, 2), T.LongType()], T.DecimalType(38, 2)),
        ([T.DateType(), T.TimestampType()], T.TimestampType()),
        ([T.BooleanType(), T.LongType()], T.StringType()),
        ([T.StringType(), T.StringType()], T.StringType()),
    ],
)
def test_promotion(given, wanted):
    assert promoted(given) == wanted and promoted(given[::-1]) == wanted
