"""Text helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts a CSV reader of the pandas kind takes for "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def null_if_token(value: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~value.isin(*tokens), value) if tokens else value


def genre_date(genre: Column, date: Column) -> Column:
    """The lookup key ``genre#YYYY-MM-DD``."""
    return F.concat_ws("#", genre, date.cast("string"))
