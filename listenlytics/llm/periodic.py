"""Periodic runs of words, found by recompression.

The words of a block of texts, with a separator of its own round each text, are compressed
level by level: blocks of one symbol become one symbol, then pairs of neighbours (left, right)
under a two-colouring of the symbols do, and so on until one symbol is left. Equal stretches
are compressed alike except at their edges, so the longest common extension of two places
walks up the levels while both stand at a symbol's edge, and down again to the first
difference, with a bounded number of steps for each level.

A run of period q and exponent e covers e - 1 neighbouring multiples of q whose words equal
those q later. So the candidates are the places of the harmonic grid (multiples of q for every
q) that pass this test and some probes between them; the extensions to both sides then give
the whole run, and of several periods of one stretch the smallest counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import map_texts
from .words import TextBlock, mix, text_blocks

MIN_LENGTH = 6
MIN_EXPONENT = 4
GRID_PLACES = 1 << 20
ROUNDS = 4
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


@dataclass
class Level:
    """One sequence of the grammar and how it is compressed to the next.

    ``first``: for each symbol of the next level the place of its first symbol here, and the
    end; ``up``: for each place here its symbol there; ``is_block``: whether blocks or pairs
    were joined.
    """

    symbols: np.ndarray
    first: np.ndarray
    up: np.ndarray
    is_block: bool


def _renamed(codes: np.ndarray) -> np.ndarray:
    return np.unique(codes, return_inverse=True)[1].astype(np.int64)


class Grammar:
    """The levels over a sequence whose first and last symbols stand nowhere else in it."""

    def __init__(self, symbols: np.ndarray):
        self.levels: list[Level] = []
        row = symbols.astype(np.int64)
        while len(row) > 1:
            edges = np.concatenate(([True], row[1:] != row[:-1]))
            if not edges.all():
                row = self._joined(row, edges, True)
            if len(row) > 1:
                row = self._joined(row, self._pair_edges(row), False)

    def _pair_edges(self, row: np.ndarray) -> np.ndarray:
        """Where symbols of the next level begin when pairs of colours (left, right) are joined."""
        seed = len(self.levels)
        while True:
            left = (mix(row.astype(np.uint64) + np.uint64(seed << 40)) >> np.uint64(63)).astype(bool)
            forward, backward = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
            joined = max(forward, backward, key=np.count_nonzero)
            if joined.any():
                return np.concatenate(([True], ~joined))
            seed += 1 << 10

    def _joined(self, row: np.ndarray, edges: np.ndarray, is_block: bool) -> np.ndarray:
        first = np.append(np.flatnonzero(edges), len(row))
        up = np.cumsum(edges) - 1
        self.levels.append(Level(row.astype(np.int32), first.astype(np.int32), up.astype(np.int32), is_block))
        begins = first[:-1]
        size = np.diff(first)
        if is_block:
            return _renamed(row[begins] * (len(row) + 1) + size)
        second = np.where(size == 2, row[np.minimum(begins + 1, len(row) - 1)] + 1, 0)
        return _renamed(row[begins] * (int(row.max()) + 2) + second)

    def extension(self, a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
        """How many symbols are equal from ``a`` and ``b`` on, the places themselves included.

        ``step`` is 1 to the right and -1 to the left; no ``a`` may equal its ``b``.
        """
        origin = a
        a, b = a.astype(np.int64), b.astype(np.int64)
        level_of = np.zeros(len(a), np.int64)  # where the first difference was seen
        going = np.arange(len(a))
        for number, level in enumerate(self.levels):
            if not len(going):
                break
            x, y = a[going], b[going]
            inside = ~(self._at_edge(level, x, step) & self._at_edge(level, y, step))
            same = level.symbols[x] == level.symbols[y]
            ended = inside & ~same
            move = inside & same
            if level.is_block:
                rest_x, rest_y = self._rest(level, x, step), self._rest(level, y, step)
                ended |= move & (rest_x != rest_y)
                move = np.where(move, np.minimum(rest_x, rest_y), 0)
            x, y = x + step * move, y + step * move
            a[going], b[going] = x, y
            level_of[going[ended]] = number
            going = going[~ended]
            a[going], b[going] = level.up[x[~ended]], level.up[y[~ended]]
        for number in range(len(self.levels) - 2, -1, -1):
            down = np.flatnonzero(level_of > number)
            if not len(down):
                continue
            level = self.levels[number]
            ends = level.first[:-1] if step > 0 else level.first[1:] - 1
            x, y = ends[a[down]].astype(np.int64), ends[b[down]].astype(np.int64)
            move = (level.symbols[x] == level.symbols[y]).astype(np.int64)
            if level.is_block:
                move *= np.minimum(self._rest(level, x, step), self._rest(level, y, step))
            a[down], b[down] = x + step * move, y + step * move
        return np.abs(a - origin)

    @staticmethod
    def _at_edge(level: Level, x: np.ndarray, step: int) -> np.ndarray:
        """Whether the symbol at ``x`` is the first (to the left: the last) of its joined symbol."""
        joined = level.up[x]
        return x == (level.first[joined] if step > 0 else level.first[joined + 1] - 1)

    @staticmethod
    def _rest(level: Level, x: np.ndarray, step: int) -> np.ndarray:
        """How many symbols of its block lie from ``x`` on, ``x`` included."""
        joined = level.up[x]
        return (level.first[joined + 1] - x if step > 0 else x - level.first[joined] + 1).astype(np.int64)


def _grid(symbols: np.ndarray, ends: np.ndarray, longest: int, exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, periods) of the harmonic grid that may lie in runs, by period and place.

    ``ends[q]`` is the end of the texts that are long enough for a run of period ``q``; longer
    texts stand first. The grid is taken in portions of about ``GRID_PLACES`` places.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    q = 1
    while q <= longest // exponent:
        periods = np.arange(q, min(longest // exponent, q + GRID_PLACES) + 1)
        counts = np.maximum((ends[periods] - 1) // periods - (exponent - 2), 0)
        taken = max(1, int(np.searchsorted(np.cumsum(counts), GRID_PLACES, side="right")))
        periods, counts = periods[:taken], counts[:taken]
        q += taken
        period = np.repeat(periods, counts)
        place = (np.arange(len(period)) - np.repeat(np.cumsum(counts) - counts, counts)) * period
        for multiple in range(exponent - 1):
            keep = symbols[place + multiple * period] == symbols[place + (multiple + 1) * period]
            place, period = place[keep], period[keep]
        for eighth in range(1, 8 * (exponent - 2)):
            x = place + period * eighth // 8
            keep = symbols[x] == symbols[x + period]
            place, period = place[keep], period[keep]
        found.append((place, period))
    nothing = np.zeros(0, np.int64)
    return (
        np.concatenate([nothing, *[place for place, _ in found]]),
        np.concatenate([nothing, *[period for _, period in found]]),
    )


def find_runs(
    symbols: np.ndarray, ends: np.ndarray, longest: int, min_length: int, exponent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and period.

    Neighbouring candidates of one period lie in one run as far as the first one's extension
    reaches, so it stands for them; those behind it are extended next.
    """
    place, period = _grid(symbols, ends, longest, exponent)
    starts, lengths, periods = ([np.zeros(0, np.int64)] for _ in range(3))
    grammar = Grammar(symbols) if len(place) else None
    turn = 0
    while len(place):
        follows = np.zeros(len(place), bool)
        if turn < ROUNDS:
            follows[1:] = (period[1:] == period[:-1]) & (place[1:] == place[:-1] + period[1:])
        head = np.flatnonzero(~follows)
        x, q = place[head], period[head]
        ahead = grammar.extension(x, x + q, 1)
        behind = grammar.extension(x, x + q, -1) - 1
        length = behind + q + ahead
        good = length >= np.maximum(min_length, exponent * q)
        starts.append((x - behind)[good])
        lengths.append(length[good])
        periods.append(q[good])
        chain = np.cumsum(~follows) - 1
        left = follows & (place > (x + ahead)[chain])
        place, period = place[left], period[left]
        turn += 1
    start, length, period = (np.concatenate(parts) for parts in (starts, lengths, periods))
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    first = np.ones(len(start), bool)  # of one stretch the smallest period
    first[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[first], length[first], period[first]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _laid_out(block: TextBlock, n_texts: int, exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The words as numbers with separators, longer texts first; each text's start; period to end."""
    words = np.unique(block.hashes(), return_inverse=True)[1]
    n_words = np.diff(block.word_of)
    order = np.argsort(-n_words, kind="stable")
    begins = np.empty(n_texts, np.int64)
    begins[order] = np.cumsum(n_words[order] + 1) - n_words[order]
    symbols = np.empty(len(words) + n_texts + 1, np.int64)
    is_word = np.ones(len(symbols), bool)
    is_word[begins - 1] = False
    is_word[-1] = False
    at = np.repeat(begins - block.word_of[:-1], n_words) + np.arange(len(words))
    symbols[at] = words
    symbols[~is_word] = len(words) + np.arange(n_texts + 1)
    longest = int(n_words.max(initial=0))
    periods = np.arange(longest // exponent + 1)
    fit = np.searchsorted(-n_words[order], -exponent * periods, side="right")  # texts long enough
    text_ends = np.concatenate(([0], np.cumsum(n_words[order] + 1))) + 1
    return symbols, begins, text_ends[fit], longest


def _joined_words(block: TextBlock, keep: np.ndarray, n_texts: int) -> list[bytes]:
    """For each text its kept words, joined by one space."""
    starts, sizes = block.starts[keep], block.ends[keep] - block.starts[keep] + 1
    behind = np.cumsum(sizes)
    out = block.data[np.repeat(starts - (behind - sizes), sizes) + np.arange(int(sizes.sum()))]
    out[behind - 1] = 0x20
    cuts = np.concatenate(([0], behind))[np.concatenate(([0], np.cumsum(keep)))[block.word_of]]
    whole = out.tobytes()
    return [whole[cuts[i] : max(cuts[i], cuts[i + 1] - 1)] for i in range(n_texts)]


def block_runs(block: TextBlock, n_texts: int, min_length: int, exponent: int) -> list[tuple]:
    """For each text (n_words, starts, lengths, periods, collapsed bytes)."""
    symbols, begins, ends, longest = _laid_out(block, n_texts, exponent)
    start, length, period = find_runs(symbols, ends, longest, min_length, exponent)
    by_begin = np.argsort(begins, kind="stable")
    text = by_begin[np.searchsorted(begins[by_begin], start, side="right") - 1]
    local = start - begins[text]
    change = np.zeros(len(block.starts) + 1, np.int64)
    first_word = block.word_of[text] + local
    np.add.at(change, first_word + period, 1)
    np.add.at(change, first_word + length, -1)
    collapsed = _joined_words(block, np.cumsum(change[:-1]) == 0, n_texts)
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(n_texts + 1))
    n_words = np.diff(block.word_of)
    return [
        (int(n_words[i]), *[c[order[cuts[i] : cuts[i + 1]]] for c in (local, length, period)], collapsed[i])
        for i in range(n_texts)
    ]


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """(``id_col``, n_words, runs, collapsed) of every row.

    ``runs`` are all maximal stretches of words with smallest period q and a length of at
    least ``min_length`` and ``min_exponent`` * q (2 or more), by start, then period;
    ``collapsed`` is the text without what a run repeats after its first q words, its words
    joined by one space. Words are runs of characters other than space and 0x09-0x0D,
    compared by 64-bit hashes. Null and empty texts have no words, no runs and an empty
    ``collapsed``. One row for each input row; repeated rows and null ids stay. A text is
    compressed whole, with some hundred bytes for each of its words.
    """
    if min_exponent < 2:
        raise ValueError("a run repeats its period at least once")
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def start():
        def make(column: pa.Array) -> list[pa.Array]:
            rows = [
                row
                for first, last, block in text_blocks(column)
                for row in block_runs(block, last - first, min_length, min_exponent)
            ]
            parts = [
                pa.array(np.concatenate([np.zeros(0, np.int64), *[row[i] for row in rows]])) for i in (1, 2, 3)
            ]
            offsets = np.concatenate(([0], np.cumsum([len(row[1]) for row in rows]))).astype(np.int32)
            runs = pa.ListArray.from_arrays(
                pa.array(offsets), pa.StructArray.from_arrays(parts, fields=list(kind.value_type))
            )
            texts = pa.array([row[4] for row in rows], pa.binary()).cast(pa.string())
            return [pa.array([row[0] for row in rows], pa.int64()), runs, texts]

        return make

    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = map_texts(named, "_text", f"n_words long, runs {RUNS}, collapsed string", start, ["_id"])
    return found.withColumnRenamed("_id", id_col)


def repeating_texts(doc_id: Column, text: Column) -> Column:
    """The given texts of the query: in a tenth of the rows the words from one on repeat a stretch.

    With h the crc32 of the id in decimal, rows with h % 10 = 0 are changed.
    """
    number = F.crc32(F.encode(doc_id.cast("string"), "UTF-8"))
    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def planted(w: Column) -> Column:
        n, g = F.size(w), F.floor(number / 10)
        a = (g % n).cast("int")
        left = (n - a).cast("int")
        p = (1 + F.floor(left / (3 + g % 8))).cast("int")
        times = F.ceil(left / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), 1, left)
        return F.array_join(F.concat(F.slice(w, 1, a), tail), " ")

    has_words = F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]")) > 0, F.lit(False))
    changed = F.transform(F.array(words), planted)[0]  # so that the words are split once
    return F.when((number % 10 == 0) & has_words, changed).otherwise(text)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Count, longest run and digests of the runs of the planted texts, for each document."""
    planted = docs.select(
        F.col(id_col).alias("_id"), repeating_texts(F.col(id_col), F.col(text_col).cast("string")).alias("_text")
    )
    found = periodic_runs(planted, "_id", "_text")
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"]))
    )
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        F.col("_id").alias(id_col),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
