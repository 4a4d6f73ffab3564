"""Rows in the form the serving store takes: ISO dates, decimals, no nulls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _iso_time(value: Column) -> Column:
    text = F.replace(value.cast("string"), F.lit(" "), F.lit("T"))
    return F.when(F.contains(text, F.lit(".")), F.rpad(text, 26, "0")).otherwise(text)


def _item_value(name: str, kind: str) -> Column:
    value = F.col(f"`{name}`")
    if kind == "date":
        return value.cast("string")
    if kind.startswith("timestamp"):
        return _iso_time(value)
    if kind in ("float", "double"):
        number = F.when(~F.isnan(value), value.cast("double"))
        infinite = F.raise_error(F.lit(f"{name}: an infinite number has no item form"))
        return F.when(
            F.abs(number) == F.lit(float("inf")), infinite.cast("decimal(38,6)")
        ).otherwise(F.bround(number, 6).cast("decimal(38,6)"))
    return value


def to_items(df: DataFrame) -> DataFrame:
    """Dates and times as ISO text, floats as decimals rounded to six digits, NaN as null.

    Infinite numbers raise, as they have no decimal form.
    """
    return df.select(*[_item_value(name, kind).alias(name) for name, kind in df.dtypes])


def to_documents(df: DataFrame) -> DataFrame:
    """One JSON document for each row, without the attributes that are null."""
    return to_items(df).select(F.to_json(F.struct("*")).alias("document"))
