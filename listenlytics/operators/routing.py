"""Where a checked file, its result and its tables go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The folders below the root.
INBOX = "raw/streams"
PROCESSED = "processed/streams"
QUARANTINE = "quarantine/streams"
RESULTS = "tmp/validation"
KPI_OUTPUT = "processed/kpis"


def result_key(source_key: Column) -> Column:
    return F.concat(F.lit(f"{RESULTS}/"), source_key, F.lit(".result.json"))


def output_prefix(source_key: Column) -> Column:
    return F.concat(F.lit(f"{KPI_OUTPUT}/"), source_key)


def target_key(source_key: Column, status: Column) -> Column:
    """Archive or quarantine key: the name is the key without its first two folders.

    For keys of three parts that is the third part; a deeper key keeps its inner
    folders, so that files of the same name stay apart.
    """
    folder = F.when(status == "PASSED", PROCESSED).otherwise(QUARANTINE)
    parts = F.split(source_key, "/")
    name = F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), "/")
    return F.concat_ws("/", folder, name)


def route_files(verdicts: DataFrame) -> DataFrame:
    """Result, table and target key of every judged file."""
    return verdicts.select(
        "source_key",
        result_key(F.col("source_key")).alias("result_key"),
        output_prefix(F.col("source_key")).alias("output_prefix"),
        target_key(F.col("source_key"), F.col("status")).alias("target_key"),
    )
