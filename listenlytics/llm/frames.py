"""Running a Python function over the text column of a frame in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import small_batches

Make = Callable[[pa.Array], list[pa.Array]]


def new_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name."""
    taken = {column.lower() for column in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def map_texts(
    rows: DataFrame,
    text_col: str,
    fields: str,
    start: Callable[[], Make],
    keep: Sequence[str],
) -> DataFrame:
    """The columns ``keep`` and new columns ``fields`` (a DDL string) made from the text.

    ``start`` runs once in each task and gives the function that turns the texts of a batch
    into the new columns. Names in ``fields`` must not be in ``keep``. Bytes that are not UTF-8
    come as the replacement character.
    """
    small_batches(rows.sparkSession)
    new = T.StructType.fromDDL(fields)
    kept = rows.select(*[F.col(c) for c in keep])
    schema = T.StructType([*kept.schema.fields, *new.fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in batches:
            made = make(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=names)

    text = F.make_valid_utf8(F.col(text_col).cast("string")).alias(new_name(keep, "_text"))
    return rows.select(*[F.col(c) for c in keep], text).mapInArrow(run, schema)
