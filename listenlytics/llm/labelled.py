"""Labelled rows for training: which rows may be learned from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
SAMPLE_ROWS = 20_000


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept for testing; never null, false without an id."""
    number = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    return F.coalesce(number % FOLDS == 0, F.lit(False))


def training_labels(
    labels: DataFrame, target: str, id_col: str = "doc_id", limit: int = SAMPLE_ROWS
) -> DataFrame:
    """(``_id``, ``_label``) of at most ``limit`` labelled ids outside the held-out fold.

    The sample takes the ids with the lowest hashes, so it is the same in every run. An id
    with several labels takes the largest; null ids and labels are left out.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(target).cast("int").alias("_label"))
    known = known.where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
    return (
        known.where(~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(limit)
    )
