"""Column expressions shared by the operators; all of them stay inside the JVM."""

from .dates import has_date, listen_date, parse_time, time_is_bad
from .numbers import percent_text, to_long
from .text import NULL_TOKENS, genre_date, null_if_token

__all__ = [
    "NULL_TOKENS",
    "genre_date",
    "has_date",
    "listen_date",
    "null_if_token",
    "parse_time",
    "percent_text",
    "time_is_bad",
    "to_long",
]
