"""Counts over whole texts, worked out with numpy for a block of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .words import SPACE, TextBlock, segment_hashes, shingle_hashes, text_blocks

# The base counts' symbols, and frequent small words of four languages.
SYMBOLS = b"#*$%&|<>"
STOP_WORDS = (
    "the of and to a in is that for it with as was on be by at this from are or an "
    "der die und das den von zu mit ist im für auf nicht eine ein dem des sich als auch "
    "le la les et des en un une du que est dans pour qui sur pas au par il ne "
    "el los las y de que en un una del se por con no su para es al lo como"
).split()

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_chars",
    "n_lines",
    "n_upper",
    "n_lower",
    "n_digits",
    "n_stops",
    "n_exclaims",
    "n_same_neighbours",
    "n_distinct",
    "n_stop_words",
    "n_short_words",
    "n_long_words",
    "n_ended_lines",
)
COUNT_FIELDS = ", ".join(f"{name} long" for name in COUNTS)


def _mask(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_IS = {
    "n_symbols": _mask(SYMBOLS),
    "n_upper": _mask(bytes(range(ord("A"), ord("Z") + 1))),
    "n_lower": _mask(bytes(range(ord("a"), ord("z") + 1))),
    "n_digits": _mask(b"0123456789"),
    "n_stops": _mask(b".,;:?"),
    "n_exclaims": _mask(b"!"),
}
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False
_WORD_CHAR = _LEAD & ~SPACE


def _word_hashes(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in data])
    starts = np.concatenate(([0], ends[:-1]))
    return segment_hashes(np.frombuffer(b"".join(data), np.uint8), starts, ends)


_STOP = np.unique(_word_hashes(sorted({*STOP_WORDS, *[w.capitalize() for w in STOP_WORDS]})))


def _per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many entries of ``mask`` are set between consecutive ``bounds``."""
    return np.diff(np.concatenate(([0], np.cumsum(mask)))[bounds])


def _repeated(hashes: np.ndarray) -> np.ndarray:
    """Marks every entry whose value stands more than once."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(hashes), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _line_counts(text: bytes) -> tuple[int, int, int]:
    """Lines with a word; those equal to an earlier line; those that end like a sentence."""
    seen: set[bytes] = set()
    worded = twice = ended = 0
    for line in text.split(b"\n"):
        bare = line.strip(b" \t\x0b\x0c\r")
        if bare:
            worded += 1
            ended += bare[-1] in b".!?\"':;"
            if line in seen:
                twice += 1
            else:
                seen.add(line)
    return worded, twice, ended


def block_counts(block: TextBlock) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text of the block."""
    bounds, words = block.text_start, block.word_of
    data = block.data
    counts = {name: _per_text(table[data], bounds) for name, table in _IS.items()}
    counts["n_words"] = np.diff(words)
    counts["word_chars"] = _per_text(_WORD_CHAR[data], bounds)
    counts["n_chars"] = _per_text(_LEAD[data], bounds) - 1  # less the space behind the text

    hashes = block.hashes()
    n = len(hashes)
    owner = np.repeat(np.arange(len(words) - 1), counts["n_words"])
    own = hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    windows = shingle_hashes(own, 5)
    whole = owner[: len(windows)] == owner[4:] if len(windows) else np.zeros(0, bool)
    again = np.zeros(len(windows), bool)
    again[whole] = _repeated(windows[whole])
    change = np.zeros(n + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + 5, -1)
    counts["n_repeat_words"] = _per_text(np.cumsum(change[:n]) > 0, words)

    neighbours = np.zeros(n, bool)
    if n:
        neighbours[1:] = own[1:] == own[:-1]
    counts["n_same_neighbours"] = _per_text(neighbours, words)
    order = np.argsort(own, kind="stable")
    first = np.zeros(n, bool)
    if n:
        ordered = own[order]
        first[order[np.concatenate(([True], ordered[1:] != ordered[:-1]))]] = True
    counts["n_distinct"] = _per_text(first, words)
    place = np.searchsorted(_STOP, hashes).clip(max=len(_STOP) - 1)
    counts["n_stop_words"] = _per_text(_STOP[place] == hashes, words)
    leads = np.concatenate(([0], np.cumsum(_LEAD[data])))
    lengths = leads[block.ends] - leads[block.starts]
    counts["n_short_words"] = _per_text(lengths <= 2, words)
    counts["n_long_words"] = _per_text(lengths >= 12, words)

    raw = data.tobytes()
    lines = [_line_counts(raw[a : b - 1]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    counts["n_lines"], counts["n_dup_lines"], counts["n_ended_lines"] = (
        np.array(lines, np.int64).reshape(-1, 3).T
    )
    return counts


def count_table(column: pa.Array) -> np.ndarray:
    """One row of ``COUNTS`` for each text; null texts count as empty."""
    rows = []
    for _, _, block in text_blocks(column):
        counts = block_counts(block)
        rows.append(np.column_stack([counts[name] for name in COUNTS]))
    return np.concatenate(rows) if rows else np.zeros((0, len(COUNTS)), np.int64)


def count_columns(column: pa.Array) -> list[pa.Array]:
    table = count_table(column)
    return [pa.array(np.ascontiguousarray(table[:, i])) for i in range(len(COUNTS))]
