"""The song catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# The columns of the catalogue.
CATALOGUE_COLUMNS = ("track_id", "track_genre", "duration_ms", "track_name", "artists")


def read_catalogue(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Catalogue CSV with a header and doubled quotes, pruned to the five columns in use.

    Everything is read as text: no inference pass, and an id like ``007`` stays itself.
    """
    return (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
        .select(*CATALOGUE_COLUMNS)
    )
