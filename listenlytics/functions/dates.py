"""Listening times: one parser for the check and for the KPIs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_time(value: Column, formats: Sequence[str] = ()) -> Column:
    """Timestamp of a text or typed time; null where it cannot be read, also in ANSI mode.

    ``formats`` are tried in order after the standard form.
    """
    attempts = [value.try_cast("timestamp")]
    attempts += [F.try_to_timestamp(value.cast("string"), F.lit(f)) for f in formats]
    return F.coalesce(*attempts)


def time_is_bad(value: Column, formats: Sequence[str] = ()) -> Column:
    return value.isNotNull() & parse_time(value, formats).isNull()


def has_date(value: Column, formats: Sequence[str] = ()) -> Column:
    """Whether ``listen_date`` gives a day, at the cost of one parse."""
    checks = [value.try_cast("date").isNotNull()]
    checks += [F.try_to_timestamp(value.cast("string"), F.lit(f)).isNotNull() for f in formats]
    return reduce(or_, checks)


def listen_date(value: Column, formats: Sequence[str] = ()) -> Column:
    """Calendar day of a listening time in the session time zone, null where unreadable.

    A zone offset in the text is honoured. Text that only starts with a date keeps
    that date; text without a date (a bare clock time) has none.
    """
    day = value.try_cast("date")
    standard = F.when(
        day.isNotNull(), F.coalesce(value.try_cast("timestamp").try_cast("date"), day)
    )
    extra = [F.try_to_timestamp(value.cast("string"), F.lit(f)).try_cast("date") for f in formats]
    return F.coalesce(standard, *extra) if extra else standard
