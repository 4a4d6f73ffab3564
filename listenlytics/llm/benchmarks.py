"""Benchmark passages in documents, also edited ones, by embedding edit distance.

Texts are sequences of words (letters, digits and characters beyond ASCII; A-Z lower-cased).
A CGK walk reads a sequence with a pointer that moves on or stays by a random bit of (step,
word), and writes the word under the pointer at every step: sequences a few edits apart fall
into step again, so their written words agree at most steps, and edit distance becomes
Hamming distance. Every walk is sampled several times at a few steps; sequences that agree
on one whole sample are candidates. How many steps a sample has is chosen for each class of
item lengths, by simulation on the items themselves, edited at the limit, to reach the recall
asked for. Candidates are
verified by the exact edit distance of the item to the best stretch of the document.

Windows as long as an item start where the document and the item share a word trigram: an
item within the limit keeps at least one trigram, since the limit is below a third of them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .frames import map_texts, new_name
from .words import NOT_ALPHANUMERIC, TextBlock, mix, shingle_hashes, text_blocks

SHARE = 0.25
RECALL = 0.95
WALKS, SAMPLES = 8, 16
TRIALS = 400  # edited copies that a sampler is chosen by, at least
MAX_ITEMS = 20_000  # items in one pass over the documents; more items take more passes
GRAM = 3
SHIFTS = (0, -1, 1)
WALK_CELLS = 1 << 18  # windows times words in one walk
_BITMAP = 1 << 20


def max_edits(n_words: int, share: float = SHARE) -> int:
    """The limit for an item: a share of its words, and less than a third of its trigrams."""
    return max(0, min(int(share * n_words), (n_words - GRAM) // GRAM))


def word_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """The word hashes of each text."""
    for first, last, block in text_blocks(column, True, NOT_ALPHANUMERIC):
        hashes = block.hashes()
        for i in range(last - first):
            yield hashes[block.word_of[i] : block.word_of[i + 1]]


def walk(windows: np.ndarray, lengths: np.ndarray, seed: int, n_steps: int) -> np.ndarray:
    """The words that the CGK walk ``seed`` writes at each step, one row for each window.

    ``windows`` has a row of words for each window, ``lengths`` their number; behind the end
    the walk writes 0.
    """
    n, width = windows.shape
    padded = np.concatenate([windows, np.zeros((n, 1), np.uint64)], axis=1).ravel()
    row_start = np.arange(n) * (width + 1)
    pointer, last = row_start.copy(), row_start + lengths
    written = np.zeros((n_steps, n), np.uint64)
    factors = mix(np.arange(1, n_steps + 1, dtype=np.uint64) * np.uint64(2 * seed + 1)) | np.uint64(1)
    for step in range(n_steps):
        word = padded[pointer]
        written[step] = word
        pointer += ((word * factors[step]) >> np.uint64(63)).astype(np.int64)
        np.minimum(pointer, last, out=pointer)
    return written


@dataclass
class Sampler:
    """For each walk its sampled steps, as shares of twice the window's length.

    A pointer moves at every second step, so these steps cover the window.
    """

    shares: np.ndarray  # walk, sample, bit

    def keys(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A key for each window (its words, then zeros) and each sample of each walk."""
        walks, samples, bits = self.shares.shape
        n = len(windows)
        out = np.zeros((n, walks * samples), np.uint64)
        n_steps = 2 * int(lengths.max(initial=0))
        for w in range(walks):
            written = walk(windows, lengths, w, n_steps if bits else 0)
            key = np.repeat(lengths.astype(np.uint64)[:, None], samples, axis=1)
            for bit in range(bits):
                steps = (self.shares[w, :, bit][None, :] * (2 * lengths)[:, None]).astype(np.int64)
                key = mix(key * np.uint64(0xA0761D6478BD642F) + written[steps, np.arange(n)[:, None]])
            out[:, w * samples : (w + 1) * samples] = key + np.arange(
                w * samples, (w + 1) * samples, dtype=np.uint64
            )
        return out


def _as_rows(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sequences as rows of one matrix, zeros behind their ends, and their lengths."""
    lengths = np.array([len(w) for w in words], np.int64)
    rows = np.zeros((len(words), int(lengths.max(initial=0))), np.uint64)
    for row, w in zip(rows, words, strict=True):
        row[: len(w)] = w
    return rows, lengths


def _sampler(bits: int) -> Sampler:
    rng = np.random.default_rng(71)
    return Sampler(rng.random((WALKS, SAMPLES, bits)))


EDITS = ("delete", "insert", "replace", "any")


def _edited(item: np.ndarray, edits: int, rng: np.random.Generator, kind: str = "any") -> np.ndarray:
    """The item's length of words from the start of a copy with that many random edits of a kind."""
    words = list(item)
    for _ in range(edits):
        edit = EDITS[rng.integers(3)] if kind == "any" else kind
        place = int(rng.integers(max(len(words), 1)))
        if edit == "delete" and len(words) > 1:
            del words[place]
        elif edit == "insert":
            words.insert(place, np.uint64(rng.integers(1, 2**62)))
        elif words:
            words[place] = np.uint64(rng.integers(1, 2**62))
    filler = [np.uint64(x) for x in rng.integers(1, 2**62, len(item))]
    return np.array([*words, *filler][: len(item)], np.uint64)


def length_class(n_words: int) -> int:
    """Items of one class differ in length by less than a half."""
    return int(2 * np.log2(n_words))


def choose_sampler(items: list[np.ndarray], share: float, recall: float) -> tuple[Sampler, float]:
    """The most selective sampler that finds ``recall`` of copies edited at the limit, in any way.

    Measured on edited copies of all items, ``TRIALS`` of each kind of edit at least, and by the
    kind that is found least: deletions, which let foreign words into the window. Items that
    must be copied exactly are found by any. Without bits, the last resort, nothing is ruled out.
    """
    rng = np.random.default_rng(5)
    edited = [x for x in items if len(x) and max_edits(len(x), share)]
    trials, kinds = [], []
    for copy in range(-(-TRIALS * len(EDITS) // max(len(edited), 1))):
        for number, item in enumerate(edited):
            kind = (number + copy) % len(EDITS)
            other = _edited(item, max_edits(len(item), share), rng, EDITS[kind])
            if not np.array_equal(item, other):
                trials.append((item, other))
                kinds.append(kind)
    width = max((len(x) for x, _ in trials), default=1)
    rows = max(1, WALK_CELLS // width)
    tried = np.bincount(np.array(kinds, np.int64), minlength=len(EDITS))
    for bits in (6, 5, 4, 3, 2, 1, 0):
        sampler, found = _sampler(bits), []
        for first in range(0, len(trials), rows):
            part = trials[first : first + rows]
            a, b = (sampler.keys(*_as_rows([trial[side] for trial in part])) for side in (0, 1))
            found += (a == b).any(axis=1).tolist()
        of_kind = np.bincount(np.array(kinds, np.int64), np.array(found, float), minlength=len(EDITS))
        reached = float(np.min(of_kind[tried > 0] / tried[tried > 0], initial=1.0))
        if reached >= recall:
            break
    return sampler, reached


def best_stretch(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of the item to a stretch of the text, the stretch's start and end."""
    distance = np.zeros(len(text) + 1, np.int64)
    start = np.arange(len(text) + 1)
    for row, word in enumerate(item, 1):
        swap = distance[:-1] + (text != word)
        drop = distance[1:] + 1
        better = swap <= drop
        best = np.concatenate(([row], np.where(better, swap, drop)))
        origin = np.concatenate(([0], np.where(better, start[:-1], start[1:])))
        # an inserted word costs 1 more than the place before: a running minimum of best - place
        slack = best - np.arange(len(best))
        least = np.minimum.accumulate(slack)
        fresh = np.concatenate(([True], slack[1:] < least[:-1]))
        source = np.maximum.accumulate(np.where(fresh, np.arange(len(best)), 0))
        distance, start = least + np.arange(len(best)), origin[source]
    end = int(distance.argmin())
    return int(distance[end]), int(start[end]), end


@dataclass
class Index:
    """Items with their trigrams and their sampled keys; small enough to be broadcast.

    ``samplers`` and ``recalls`` are by class of item lengths.
    """

    ids: list[int]
    items: list[np.ndarray]
    limits: list[int]
    grams: np.ndarray
    gram_places: list[list[tuple[int, int]]]  # for each trigram the (item, place) pairs
    bitmap: np.ndarray
    keys: list[set[int]]
    samplers: dict[int, Sampler]
    recalls: dict[int, float]


def build_index(ids: list[int], items: list[np.ndarray], share: float, recall: float) -> Index:
    by_class: dict[int, list[np.ndarray]] = {}
    for item in items:
        by_class.setdefault(length_class(len(item)), []).append(item)
    chosen = {c: choose_sampler(own, share, recall) for c, own in by_class.items()}
    samplers = {c: sampler for c, (sampler, _) in chosen.items()}
    places: dict[int, list[tuple[int, int]]] = {}
    for number, item in enumerate(items):
        for place, gram in enumerate(_grams(item)):
            places.setdefault(int(gram), []).append((number, place))
    grams = np.array(sorted(places), np.uint64)
    bitmap = np.zeros(_BITMAP, bool)
    bitmap[(grams & np.uint64(_BITMAP - 1)).astype(np.int64)] = True
    keys = [set(samplers[length_class(len(x))].keys(*_as_rows([x]))[0].tolist()) for x in items]
    return Index(
        ids, items, [max_edits(len(x), share) for x in items], grams,
        [places[int(g)] for g in grams], bitmap, keys, samplers, {c: reached for c, (_, reached) in chosen.items()},
    )


def _grams(words: np.ndarray) -> np.ndarray:
    """Hashes of all word trigrams; a shorter item is one gram."""
    return shingle_hashes(words, min(GRAM, len(words))) if len(words) else np.zeros(0, np.uint64)


def _near_a_copy(pair: np.ndarray, start: np.ndarray, limit: np.ndarray, needed: np.ndarray) -> np.ndarray:
    """Which shared trigrams can be of a copy: a mask over (text and item, start it speaks for).

    An edit breaks at most ``GRAM`` trigrams of the item and moves the start by at most one, so
    a copy within the limit keeps ``needed`` of them, whose starts differ by the limit at most.
    """
    order = np.lexsort((start, pair))
    spread = int(np.ptp(start)) + int(limit.max()) + 1
    key = (pair * spread + start - start.min())[order]
    end = np.searchsorted(key, key + limit[order], "right")
    first = np.flatnonzero(end - np.arange(len(key)) >= needed[order])
    covered = np.zeros(len(key) + 1, np.int64)
    np.add.at(covered, first, 1)
    np.add.at(covered, end[first], -1)
    mask = np.zeros(len(key), bool)
    mask[order] = np.cumsum(covered[:-1]) > 0
    return mask


def _proposals(block: TextBlock, hashes: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """The (window length, text, window start, item) that shared trigrams propose, each once, in order.

    Only trigrams that have as many others of their item near them as every copy has propose
    one (``_near_a_copy``). A window may begin before its text when the item's first words are
    missing there; the one from the text's start is then proposed too. Left out is where more
    words of the item are beyond the text's edges than its limit.
    """
    found: set[tuple[int, int, int, int]] = set()
    lengths = np.array([len(x) for x in index.items])
    limits = np.array(index.limits)
    n_places = np.array([len(places) for places in index.gram_places])
    begin = np.cumsum(n_places) - n_places
    flat = np.array([pair for places in index.gram_places for pair in places]).reshape(-1, 2)
    for size in {min(GRAM, n) for n in lengths.tolist()}:
        grams = shingle_hashes(hashes, size)
        near = np.flatnonzero(index.bitmap[(grams & np.uint64(_BITMAP - 1)).astype(np.int64)])
        at = np.searchsorted(index.grams, grams[near]).clip(max=len(index.grams) - 1)
        exact = index.grams[at] == grams[near]
        near, at = near[exact], at[exact]
        texts = np.searchsorted(block.word_of, near, "right") - 1
        inside = near + size <= block.word_of[texts + 1]
        near, at, texts = near[inside], at[inside], texts[inside]
        # each occurrence with each place of its trigram in an item
        which = np.repeat(np.arange(len(near)), n_places[at])
        rank = np.arange(len(which)) - np.repeat(np.cumsum(n_places[at]) - n_places[at], n_places[at])
        item, place = flat[begin[at][which] + rank].T
        text, start, length = texts[which], near[which] - place, lengths[item]
        low, high = block.word_of[text], block.word_of[text + 1]
        missing = np.maximum(0, low - start) + np.maximum(0, start + length - high)
        fits = (np.minimum(GRAM, length) == size) & (missing <= limits[item])
        text, start, item, low = text[fits], start[fits], item[fits], low[fits]
        if not len(text):
            continue
        limit = limits[item]
        needed = lengths[item] - size + 1 - size * limit
        copied = _near_a_copy(text * len(lengths) + item, start, limit, needed)
        rows = zip(*(x[copied].tolist() for x in (lengths[item], text, start, item, low)), strict=True)
        for length, text, start, item, first in rows:
            found.update((length, text, start + shift, item) for shift in SHIFTS)
            if start - 1 < first:
                found.add((length, text, first, item))
    return sorted(found)


def _candidates(
    block: TextBlock, hashes: np.ndarray, index: Index
) -> Iterator[tuple[int, int, int]]:
    """(text, window start, item) of the windows that agree with an item on a whole sample."""
    proposals = _proposals(block, hashes, index)
    done = 0
    while done < len(proposals):
        # as many windows of the ascending lengths as fit into the memory for one walk
        end = min(len(proposals), done + max(1, WALK_CELLS // proposals[done][0]))
        end = min(end, done + max(1, WALK_CELLS // proposals[end - 1][0]))
        group = length_class(proposals[done][0])
        end = bisect_left(proposals, group + 1, done, end, key=lambda p: length_class(p[0]))
        part = proposals[done:end]
        done = end
        windows, which = np.unique(np.array([p[:3] for p in part]), axis=0, return_inverse=True)
        lengths, text_of, starts = windows.T
        low, high = block.word_of[text_of], block.word_of[text_of + 1]
        places = starts[:, None] + np.arange(lengths.max())
        inside = (places >= low[:, None]) & (places < high[:, None])
        # the walk must move on over words before the text, so these are distinct and not zero
        before = mix(places.astype(np.uint64)) | np.uint64(1)
        words = np.where(inside, hashes[places.clip(0, len(hashes) - 1)], np.uint64(0))
        words = np.where(places < low[:, None], before, words)
        words[np.arange(lengths.max()) >= lengths[:, None]] = 0
        keys = index.samplers[group].keys(words, lengths).tolist()
        for (_, text, start, item), place in zip(part, which.ravel().tolist(), strict=True):
            if not index.keys[item].isdisjoint(keys[place]):
                yield text, start, item


def _stretches(
    block: TextBlock, hashes: np.ndarray, index: Index
) -> Iterator[tuple[tuple[int, int], tuple[int, int]]]:
    """((text, item), (first word, word behind the last)) round the candidates, overlapping ones as one."""
    wanted: dict[tuple[int, int], list[tuple[int, int]]] = {}
    if len(hashes) and index.items:
        for text, start, item in _candidates(block, hashes, index):
            reach = index.limits[item] + 1
            a = max(int(block.word_of[text]), start - reach)
            b = min(int(block.word_of[text + 1]), start + len(index.items[item]) + reach)
            if a < b:
                wanted.setdefault((text, item), []).append((a, b))
    for pair, ranges in wanted.items():
        ranges.sort()
        a, b = ranges[0]
        for c, d in ranges[1:]:
            if c >= b:
                yield pair, (a, b)
                a = c
            b = max(b, d)
        yield pair, (a, b)


def find_items(column: pa.Array, index: Index) -> list[list[tuple[int, int, int, int]]]:
    """For each text the (item id, edits, first word, word behind the last) of its passages.

    The best stretch of each item is given, the first of equally good ones.
    """
    results: list[list[tuple[int, int, int, int]]] = []
    for first, last, block in text_blocks(column, True, NOT_ALPHANUMERIC):
        hashes = block.hashes()
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for (text, item), (a, b) in _stretches(block, hashes, index):
            if best.get((text, item), (1,))[0] == 0:
                continue  # nothing is better than a whole copy
            low = int(block.word_of[text])
            edits, begin, end = best_stretch(index.items[item], hashes[a:b])
            if edits <= index.limits[item]:
                found = (edits, a - low + begin, a - low + end)
                best[text, item] = min(best.get((text, item), found), found)
        by_text: dict[int, list[tuple[int, int, int, int]]] = {}
        for (text, item), (edits, begin, end) in sorted(best.items()):
            by_text.setdefault(text, []).append((index.ids[item], edits, begin, end))
        results += [by_text.get(i, []) for i in range(last - first)]
    return results


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, share: float, recall: float) -> Iterator[Index]:
    """Indexes over at most ``MAX_ITEMS`` items each, in the order of their ids' hashes.

    Items without an id or without a word are left out; an item that stands several times
    is taken once for each text.
    """
    items = benchmark.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = items.where("id IS NOT NULL AND text IS NOT NULL").distinct()
    n_blocks = max(1, -(-items.count() // MAX_ITEMS))
    for number in range(n_blocks):
        mine = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == number).orderBy("id", "text").collect()
        words = list(word_rows(pa.array([row["text"] for row in mine], pa.string())))
        kept = [(row["id"], w) for row, w in zip(mine, words, strict=True) if len(w)]
        yield build_index([i for i, _ in kept], [w for _, w in kept], share, recall)


FOUND = "array<struct<item_id:bigint,edits:int,first_word:int,end_word:int>>"
_FOUND_TYPE = pa.list_(
    pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("first_word", pa.int32()), ("end_word", pa.int32())])
)


def _finder(spark: SparkSession, index: Index, make_column: Callable) -> Callable:
    shared = spark.sparkContext.broadcast(index)

    def start():
        def make(column: pa.Array) -> list[pa.Array]:
            return [make_column(find_items(column, shared.value))]

        return make

    return start


def _as_structs(found: list[list[tuple[int, int, int, int]]]) -> pa.Array:
    names = ("item_id", "edits", "first_word", "end_word")
    return pa.array([[dict(zip(names, f, strict=True)) for f in one] for one in found], _FOUND_TYPE)


def _as_flags(found: list[list[tuple[int, int, int, int]]]) -> pa.Array:
    return pa.array([bool(one) for one in found], pa.bool_())


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    share: float = SHARE,
    recall: float = RECALL,
) -> DataFrame:
    """(``id_col``, item_id, edits, first_word, end_word): the benchmark items in each document.

    An item is in a document when a stretch of the document's words is within
    ``max_edits(words of the item, share)`` word edits; the best stretch is given. Every
    whole text is read. Null and empty texts, and an empty benchmark, give no rows. Repeated
    documents give repeated rows; rows without an id are reported with a null id.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = None
    for index in _item_blocks(benchmark, item_id_col, item_text_col, share, recall):
        part = map_texts(named, "_text", f"found {FOUND}", _finder(spark, index, _as_structs), ["_id"])
        rows = part if rows is None else rows.unionByName(part)
    flat = rows.select(F.col("_id").alias(id_col), F.inline("found"))
    return flat


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", share: float = SHARE, recall: float = RECALL
) -> DataFrame:
    """The rows whose text holds no benchmark item, with their own columns only.

    Null and empty texts hold none and stay, as do all rows where there are no items; each of
    repeated rows is judged for itself. Other columns may have any name.
    """
    spark = docs.sparkSession
    flag = new_name(docs.columns, "_contaminated")
    rows = docs
    for index in _item_blocks(benchmark, "item_id", "text", share, recall):
        judged = map_texts(
            rows, text_col, f"`{flag}` boolean", _finder(spark, index, _as_flags), docs.columns
        )
        rows = judged.where(~F.col(flag)).drop(flag)
    return rows
