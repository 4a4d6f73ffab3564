"""Words of whole Arrow text columns as 64-bit hashes, worked out for many texts at once.

A word is a maximal run of bytes other than space and 0x09-0x0D, which on UTF-8 is the same
as a maximal run of such characters.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

CHUNK_BYTES = 1 << 18
BATCH_ROWS = "500"

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# Separators of words that hold only letters, digits and characters beyond ASCII.
NOT_ALPHANUMERIC = np.zeros(256, bool)
NOT_ALPHANUMERIC[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


_shipped: dict[str, str] = {}


def small_batches(spark: SparkSession) -> None:
    """Ready a session for Python tasks on texts.

    Fewer rows go to Python in each batch, so that long texts fit in memory, and Spark hands
    this package to every executor, once in each application.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="listenlytics-"), "listenlytics")
        _shipped[context.applicationId] = shutil.make_archive(
            archive, "zip", os.path.dirname(package), os.path.basename(package)
        )
        context.addPyFile(_shipped[context.applicationId])


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, 2 * CHUNK_BYTES)
        for place, base in enumerate((_BASE, _BASE_INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[place] = np.cumprod(table)
    return _powers[0], _powers[1]


def mix(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    v = values.astype(np.uint64, copy=True)
    v ^= v >> np.uint64(30)
    v *= np.uint64(0xBF58476D1CE4E5B9)
    v ^= v >> np.uint64(27)
    v *= np.uint64(0x94D049BB133111EB)
    v ^= v >> np.uint64(31)
    return v


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each ``data[start:end]``, the same for equal bytes anywhere."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[: len(data)], out=sums[1:])
    found = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class TextBlock:
    """The words of some consecutive texts.

    ``data``: their bytes, a zero-width gap of one space between texts; ``text_start``: where
    each text begins; ``starts``/``ends``: the words; ``word_of``: for each text the number of
    the first word, one entry more than texts.
    """

    def __init__(
        self, data: np.ndarray, text_start: np.ndarray, lower: bool, separators: np.ndarray = SPACE
    ):
        if lower:
            data = _LOWER[data]
        self.data, self.text_start = data, text_start
        inside = ~separators[data]
        edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
        self.starts = np.flatnonzero(edges == 1)
        self.ends = np.flatnonzero(edges == -1)
        self.word_of = np.searchsorted(self.starts, text_start)

    def hashes(self) -> np.ndarray:
        return segment_hashes(self.data, self.starts, self.ends)


def text_blocks(
    column: pa.Array,
    lower: bool = False,
    separators: np.ndarray = SPACE,
    chunk_bytes: int = CHUNK_BYTES,
) -> Iterator[tuple[int, int, TextBlock]]:
    """Blocks of about ``chunk_bytes`` (one text at least) as (first row, row behind the last, block).

    Null texts count as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = [(value.as_buffer() if value.is_valid else b"") for value in column.cast(pa.binary())]
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= chunk_bytes):
            size += len(texts[last]) + 1
            last += 1
        data = np.frombuffer(b" ".join([*texts[first:last], b""]), np.uint8)
        lengths = np.array([len(t) + 1 for t in texts[first:last]], np.int64)
        yield first, last, TextBlock(data, np.concatenate(([0], np.cumsum(lengths))), lower, separators)
        first = last


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for place in range(size):
        total = mix(total * np.uint64(0xA0761D6478BD642F) + words[place : place + n])
    return total
