"""Collocations: phrases whose words stand together more often than their parts foretell.

Phrases are counted by weighted acyclic automata. Every task (a shard of the texts) sorts the
phrases it met into count transducers: words are read along arcs, the weight of an arc is the
count of the phrase that ends there, and states with equal futures are one. A shard's
transducer is cut into ranges of prefixes, so that Spark brings the parts of one range
together, where their union sums the weights. Finally the phrases kept form one transducer for
each range, and composing it with the automaton of the parts that are asked for gives the
counts of all parts.

Phrases are counted by length: of k words only those of which both parts of k - 1 words are
frequent, which a bitmap of fixed size tells without missing any. The language is the first
label of every path.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import new_work_folder
from ..staging import written
from .words import TextBlock, mix, segment_hashes, small_batches, text_blocks

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
PORTION = 3 << 18
BITMAP_BITS = 26
ROWS_PER_RANGE = 8000
MIN_RANGES, MAX_RANGES = 8, 1 << 16
PHRASES_PER_RANGE = 20_000
SALTS = 8
REQUESTS = 50_000
BROADCAST_BYTES = 32 << 20
NO_LANGUAGE = "und"

_REQUEST = {"lang": "string", "phrase": "string", "a": "bigint", "cut": "int", "side": "string"}

SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E), *b".,;:!?"]] = True
BREAKS = SEPARATORS.copy()
BREAKS[[0x20, 0x09]] = False
_STEP = np.uint64(0xA0761D6478BD642F)


def _extended(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(hashes * _STEP + words)


def _word_hashes(words: Sequence[bytes]) -> np.ndarray:
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(word) for word in words], dtype=np.int64)
    return segment_hashes(data, np.concatenate(([0], ends[:-1])).astype(np.int64), ends)


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... of ``counts[i]`` numbers, for all i."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def _small(values: np.ndarray) -> np.ndarray:
    top = int(values.max(initial=0))
    return values.astype(next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max))


@dataclass
class Transducer:
    """An acyclic automaton over words; the weight of an arc is that of the phrase ending there.

    The arcs of state s are ``offsets[s]`` to ``offsets[s + 1]``, by label; labels are sorted.
    State 0 has none, the last state is the first one of every path. Weight 0 marks arcs at
    which no phrase ends.
    """

    labels: list[bytes]
    offsets: np.ndarray
    arc_labels: np.ndarray
    weights: np.ndarray
    targets: np.ndarray

    @classmethod
    def from_sorted(cls, labels: list[bytes], rows: np.ndarray, weights: np.ndarray) -> Transducer:
        """From different sorted phrases: a row of label numbers each, -1 behind its end.

        The states of a depth are made from those of the next: equal arcs make one state.
        """
        depth = rows.shape[1]
        lengths = (rows >= 0).sum(axis=1)
        new = np.zeros(len(rows), bool)
        new[:1] = True
        firsts = [np.zeros(1, np.int64)]
        for d in range(depth):
            new[1:] |= rows[1:, d] != rows[:-1, d]
            firsts.append(np.flatnonzero(new & (lengths > d)))
        state_of = np.zeros(len(firsts[depth]), np.int64)
        sizes, parts = [np.zeros(1, np.int64)], []
        n_states = 1
        for d in range(depth, 0, -1):
            first, above = firsts[d], firsts[d - 1]
            parent = np.searchsorted(above, first, side="right") - 1
            label = rows[first, d - 1]
            weight = np.where(lengths[first] == d, weights[first], 0)
            begins = np.flatnonzero(np.diff(parent, prepend=-1))
            counts = np.diff(np.append(begins, len(first)))
            mark = _extended(_extended(mix(label), weight.astype(np.uint64)), state_of.astype(np.uint64))
            marks = np.add.reduceat(mark, begins) if len(first) else np.zeros(0, np.uint64)
            _, kept, same = np.unique(marks, return_index=True, return_inverse=True)
            arcs = _ragged(begins[kept], counts[kept])
            parts.append((label[arcs], weight[arcs], state_of[arcs]))
            sizes.append(counts[kept])
            state_of = np.zeros(len(above), np.int64)
            state_of[parent[begins]] = n_states + same
            n_states += len(kept)
        offsets = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        return cls(labels, offsets, *[np.concatenate(column).astype(np.int64) for column in zip(*parts, strict=True)])

    def paths(self) -> tuple[np.ndarray, np.ndarray]:
        """(rows, weights) of all phrases, shorter ones padded with -1."""
        state = np.array([len(self.offsets) - 2])
        path = np.zeros((1, 0), np.int64)
        rows, weights = [], []
        while len(state):
            counts = self.offsets[state + 1] - self.offsets[state]
            arcs = _ragged(self.offsets[state], counts)
            path = np.column_stack([np.repeat(path, counts, axis=0), self.arc_labels[arcs]])
            ends = self.weights[arcs] > 0
            rows.append(path[ends])
            weights.append(self.weights[arcs][ends])
            state = self.targets[arcs]
            path, state = path[state > 0], state[state > 0]
        depth = max((r.shape[1] for r in rows), default=0)
        padded = [np.pad(r, ((0, 0), (0, depth - r.shape[1])), constant_values=-1) for r in rows]
        return np.concatenate([np.zeros((0, depth), np.int64), *padded]), np.concatenate([np.zeros(0, np.int64), *weights])

    def composed(self, counts: Transducer) -> tuple[np.ndarray, np.ndarray]:
        """(weights here, weights in ``counts``) of the phrases that both read."""
        known = {label: i for i, label in enumerate(counts.labels)}
        label_of = np.array([known.get(label, -1) for label in self.labels], np.int64)
        n_labels = len(counts.labels) + 1
        n_arcs = np.diff(counts.offsets)
        keys = np.repeat(np.arange(len(n_arcs)), n_arcs) * n_labels + counts.arc_labels
        here, there = np.array([len(self.offsets) - 2]), np.array([len(counts.offsets) - 2])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(here):
            n = self.offsets[here + 1] - self.offsets[here]
            arcs = _ragged(self.offsets[here], n)
            label = label_of[self.arc_labels[arcs]]
            wanted = np.repeat(there, n) * n_labels + label
            place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            both = (label >= 0) & (keys[place] == wanted)
            arcs, place = arcs[both], place[both]
            ends = (self.weights[arcs] > 0) & (counts.weights[place] > 0)
            found.append((self.weights[arcs][ends], counts.weights[place][ends]))
            here, there = self.targets[arcs], counts.targets[place]
            going = (here > 0) & (there > 0)
            here, there = here[going], there[going]
        return tuple(np.concatenate([np.zeros(0, np.int64), *column]) for column in zip(*found, strict=True))

    def to_bytes(self) -> bytes:
        """The columns, label numbers as steps within a state, compressed."""
        steps = np.diff(self.arc_labels, prepend=0)
        begins = self.offsets[:-1][np.diff(self.offsets) > 0]
        steps[begins] = self.arc_labels[begins]
        columns = [
            _small(np.fromiter(map(len, self.labels), np.int64, len(self.labels))),
            np.frombuffer(b"".join(self.labels), np.uint8),
            *map(_small, (np.diff(self.offsets), steps, self.weights, self.targets)),
        ]
        head = np.array([n for column in columns for n in (len(column), column.itemsize)], "<i8")
        # byte by byte of all numbers, the low ones first, so that zeros stand together
        planes = [column.view(np.uint8).reshape(-1, column.itemsize).T.tobytes() for column in columns]
        content = head.tobytes() + b"".join(planes)
        return len(content).to_bytes(8, "little") + pa.compress(content, "zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, content: bytes) -> Transducer:
        content = pa.decompress(content[8:], int.from_bytes(content[:8], "little"), "zstd", asbytes=True)
        head = np.frombuffer(content, "<i8", 12).reshape(-1, 2)
        place, columns = 96, []
        for n, size in head.tolist():
            planes = np.frombuffer(content, np.uint8, n * size, place).reshape(size, n)
            columns.append(np.ascontiguousarray(planes.T).view(f"<u{size}").reshape(-1).astype(np.int64))
            place += n * size
        lengths, blob, sizes, steps, weights, targets = columns
        blob, ends = blob.astype(np.uint8).tobytes(), np.cumsum(lengths).tolist()
        labels = [blob[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        summed = np.cumsum(steps)
        before = np.concatenate(([0], summed))[offsets[:-1]]
        return cls(labels, offsets, summed - np.repeat(before, sizes), weights, targets)


def sorted_transducer(labels: list[bytes], rows: np.ndarray, weights: np.ndarray) -> Transducer:
    """The transducer of phrases in any order, with labels in any order."""
    used = np.unique(rows[rows >= 0])
    order = sorted(used.tolist(), key=labels.__getitem__)
    number = np.full(len(labels) + 1, -1, np.int64)
    number[order] = np.arange(len(order))
    rows = number[rows]  # -1 reads the last entry
    by_words = np.lexsort(rows.T[::-1])
    return Transducer.from_sorted([labels[i] for i in order], rows[by_words], weights[by_words])


class Sums:
    """Adds up the weights of phrases, each a row of label numbers, by 64-bit hashes of the rows."""

    def __init__(self):
        self.hashes = np.zeros(0, np.uint64)
        self.weights = np.zeros(0, np.int64)
        self.rows: np.ndarray | None = None
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, hashes: np.ndarray, weights: np.ndarray, rows: np.ndarray) -> None:
        self.pending.append((hashes, weights, rows))
        self.size += len(hashes)

    def settle(self) -> None:
        if not self.pending:
            return
        if self.rows is not None:
            self.pending.append((self.hashes, self.weights, self.rows))
        hashes, weights, rows = (np.concatenate(column) for column in zip(*self.pending, strict=True))
        self.pending.clear()
        order = np.argsort(hashes, kind="stable")
        begins = np.flatnonzero(np.diff(hashes[order], prepend=hashes[order][:1] ^ np.uint64(1)))
        self.weights = np.add.reduceat(weights[order], begins) if len(order) else weights
        self.hashes, self.rows = hashes[order[begins]], rows[order[begins]]
        self.size = len(self.hashes)


class Shard:
    """The phrases of ``k`` words of one task, given out as transducers of ranges of prefixes."""

    def __init__(self, k: int, n_ranges: int, bitmap: np.ndarray | None):
        self.k, self.n_ranges, self.bitmap = k, n_ranges, bitmap
        self._clear()

    def _clear(self) -> None:
        self.sums = Sums()
        self.words: dict[int, bytes] = {}

    def _frequent(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - BITMAP_BITS)
        return (self.bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)

    def add(self, block: TextBlock, languages: list[bytes]) -> Iterator[tuple[int, bytes]]:
        """Count the phrases of a block of texts; gives transducers when there are many."""
        n = len(block.starts) - self.k + 1
        if n <= 0:
            return
        language = _word_hashes(languages)
        text = np.repeat(np.arange(len(languages)), np.diff(block.word_of))
        breaks = BREAKS[block.data]
        breaks[block.text_start[1:] - 1] = True  # the gaps between texts
        piece = np.cumsum(breaks)[block.starts]
        words = block.hashes()
        hashes = language[text]
        for place in range(self.k - 1):
            hashes = _extended(hashes[: len(words) - place], words[place:])
        good = piece[:n] == piece[self.k - 1 :]
        if self.k > 1:
            # both parts of one word less; the longer one's language is the same in a piece
            frequent = self._frequent(hashes)
            good &= frequent[:n] & frequent[1 : n + 1]
        at = np.flatnonzero(good)
        if not len(at):
            return
        grams, first, counts = np.unique(
            _extended(hashes[at], words[at + self.k - 1]), return_index=True, return_counts=True
        )
        at = at[first]
        rows = np.column_stack([language[text[at]], *[words[at + place] for place in range(self.k)]])
        self.sums.add(grams, counts, rows)
        used = np.zeros(len(words), bool)
        for place in range(self.k):
            used[at + place] = True
        used = np.flatnonzero(used)
        found, where = np.unique(words[used], return_index=True)
        data = block.data
        for word, i in zip(found.tolist(), used[where].tolist(), strict=True):
            if word not in self.words:
                self.words[word] = data[block.starts[i] : block.ends[i]].tobytes()
        for code, name in zip(language.tolist(), languages, strict=True):
            self.words[code] = name
        if self.sums.size > 2 * PORTION:
            self.sums.settle()
            if self.sums.size > PORTION:
                yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes]]:
        """(range, transducer) of all that was counted since the last time."""
        self.sums.settle()
        rows, weights = self.sums.rows, self.sums.weights
        if rows is None or not len(rows):
            return
        by_label = sorted(self.words.items(), key=lambda item: item[1])
        codes = np.array([code for code, _ in by_label], np.uint64)
        labels = [label for _, label in by_label]
        order = np.argsort(codes)
        numbers = order[np.searchsorted(codes[order], rows)]
        ranges = range_of(rows, self.n_ranges)
        by_range = np.lexsort([*numbers.T[::-1], ranges])
        numbers, weights, ranges = numbers[by_range], weights[by_range], ranges[by_range]
        cuts = np.append(np.flatnonzero(np.diff(ranges, prepend=-1)), len(ranges))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            used, part = np.unique(numbers[a:b], return_inverse=True)
            mine = [labels[i] for i in used.tolist()]
            part = part.reshape(-1, numbers.shape[1])
            yield int(ranges[a]), Transducer.from_sorted(mine, part, weights[a:b]).to_bytes()
        self._clear()


def range_of(rows: np.ndarray, n_ranges: int) -> np.ndarray:
    """The range of each phrase, a row of word hashes: by the language and up to two words."""
    prefix = mix(rows[:, 0])
    for place in range(1, min(3, rows.shape[1])):
        prefix = _extended(prefix, rows[:, place])
    return ((prefix >> np.uint64(32)) * np.uint64(n_ranges) >> np.uint64(32)).astype(np.int64)


def _shard_transducers(texts: DataFrame, k: int, n_ranges: int, bitmap: np.ndarray | None) -> DataFrame:
    """(range, automaton): the transducers of all tasks for phrases of ``k`` words."""
    context = texts.sparkSession.sparkContext
    shared = context.broadcast(bitmap) if bitmap is not None else None  # 2 ** BITMAP_BITS bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(k, n_ranges, shared.value if shared else None)

        def batch_of(given: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
            for number, automaton in given:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), pa.array([automaton], pa.binary())], names=["range", "automaton"]
                )

        for batch in batches:
            languages = [value.as_py().encode() for value in batch.column(0)]
            for first, last, block in text_blocks(batch.column(1), lower=True, separators=SEPARATORS):
                yield from batch_of(shard.add(block, languages[first:last]))
        yield from batch_of(shard.flush())

    return texts.mapInArrow(run, "range int, automaton binary")


class Union:
    """The union of transducers of one range."""

    def __init__(self):
        self.sums = Sums()
        self.numbers: dict[bytes, int] = {}

    def add(self, automaton: bytes) -> None:
        given = Transducer.from_bytes(automaton)
        rows, weights = given.paths()
        if not len(rows):
            return
        number = np.array([self.numbers.setdefault(label, len(self.numbers)) for label in given.labels], np.int64)
        rows = number[rows]
        hashes = mix(rows[:, 0])
        for place in range(1, rows.shape[1]):
            hashes = _extended(hashes, rows[:, place].astype(np.uint64))
        self.sums.add(hashes, weights, rows.astype(np.int32))
        if self.sums.size > 4 * PORTION:
            self.sums.settle()

    def frequent(self, min_count: int, with_totals: bool) -> pa.RecordBatch:
        """lang, phrase, f, gram (its hash) of the phrases at least ``min_count`` often.

        With totals also the sum of all weights of each language, without a phrase.
        """
        self.sums.settle()
        labels = list(self.numbers)
        rows, weights = self.sums.rows, self.sums.weights
        totals = np.zeros(len(labels), np.int64)
        if with_totals:
            np.add.at(totals, rows[:, 0], weights)
        kept = weights >= min_count
        rows, weights = rows[kept], weights[kept]
        codes = _word_hashes(labels)
        grams = codes[rows[:, 0]]
        for place in range(1, rows.shape[1]):
            grams = _extended(grams, codes[rows[:, place]])
        listed = rows.tolist()
        spoken = np.flatnonzero(totals).tolist()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([labels[r[0]] for r in listed] + [labels[i] for i in spoken], pa.binary()).cast(pa.string()),
                pa.array([b" ".join([labels[i] for i in r[1:]]) for r in listed] + [None] * len(spoken), pa.binary()).cast(
                    pa.string()
                ),
                pa.array(weights.tolist() + totals[spoken].tolist(), pa.int64()),
                pa.array(grams.view(np.int64).tolist() + [None] * len(spoken), pa.int64()),
            ],
            names=["lang", "phrase", "f", "gram"],
        )


def _unions(transducers: DataFrame, min_count: int, with_totals: bool) -> DataFrame:
    """The frequent phrases of all ranges, each range summed up in one task as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, union = None, None
        for batch in batches:
            for number, automaton in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if number != current:
                    if union:
                        yield union.frequent(min_count, with_totals)
                    current, union = number, Union()
                union.add(automaton.as_py())
        if union:
            yield union.frequent(min_count, with_totals)

    together = transducers.repartition("range").sortWithinPartitions("range")
    return together.mapInArrow(run, "lang string, phrase string, f long, gram long")


def _bitmap(phrases: DataFrame) -> np.ndarray:
    """The bits of the phrases' hashes; at most 2 ** (BITMAP_BITS - 6) numbers come to the driver."""
    place = F.shiftrightunsigned("gram", 64 - BITMAP_BITS)
    bits = phrases.where("gram IS NOT NULL").select(
        F.shiftright(place, 6).alias("number"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int")).alias("bits"),
    )
    rows = bits.groupBy("number").agg(F.bit_or("bits").alias("bits")).toPandas()
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    bitmap[rows["number"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def phrase_counts(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """(lang, phrase, f, k) of all phrases of 1 to ``max_words`` words with f >= ``min_count``.

    Rows without a phrase hold the number of words of a language, in parts to be added up.
    One pass over the texts for each length, until no phrase is frequent.
    """
    spark = docs.sparkSession
    small_batches(spark)
    language = F.coalesce(F.make_valid_utf8(F.col(lang_col).cast("string")), F.lit(NO_LANGUAGE))
    texts = docs.select(language.alias("lang"), F.make_valid_utf8(F.col(text_col).cast("string")).alias("text"))
    n_ranges = min(MAX_RANGES, max(MIN_RANGES, docs.count() // ROWS_PER_RANGE))
    counted, bitmap = None, None
    for k in range(1, max_words + 1):
        transducers = _shard_transducers(texts, k, n_ranges, bitmap)
        found = written(_unions(transducers, min_count, k == 1), new_work_folder(spark, f"phrases-{k}"))
        lengths = found.select("lang", "phrase", "f", F.lit(k).alias("k"))
        counted = lengths if counted is None else counted.unionByName(lengths)
        if found.where("phrase IS NOT NULL").isEmpty():
            break
        if k < max_words:
            bitmap = _bitmap(found)
    return counted


def _range_key(words: Column, salt: Column, n_ranges: int) -> Column:
    first, second = F.get(words, F.lit(1)), F.get(words, F.lit(2))  # word 0 is the language
    return F.pmod(F.xxhash64(F.get(words, F.lit(0)), first, second, salt), F.lit(n_ranges)).cast("int")


class Answers:
    """The counts of the parts that are asked for in one range."""

    def __init__(self):
        self.counts: tuple[list[list[str]], list[int]] = ([], [])
        self.asked: list[tuple] = []
        self.transducer: Transducer | None = None

    @staticmethod
    def _transducer(rows: Sequence[Sequence[str]], weights: Sequence[int]) -> Transducer:
        number: dict[str, int] = {}
        numbered = [[number.setdefault(word, len(number)) for word in row] for row in rows]
        depth = max(map(len, numbered), default=1)
        padded = np.array([row + [-1] * (depth - len(row)) for row in numbered], np.int64).reshape(-1, depth)
        return sorted_transducer([word.encode() for word in number], padded, np.array(weights, np.int64))

    def give(self) -> pa.RecordBatch:
        """The requests so far, with f; all counts must have come before."""
        if self.transducer is None:
            self.transducer = self._transducer(*self.counts)
            self.counts = ([], [])
        number = {tuple(row[1]): 0 for row in self.asked}
        number = {part: i for i, part in enumerate(number, 1)}
        here, there = self._transducer(list(number), list(number.values())).composed(self.transducer)
        found = np.zeros(len(number) + 1, np.int64)
        found[here] = there
        f = found[[number[tuple(row[1])] for row in self.asked]]
        types = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string())
        columns = [pa.array([row[i] for row in self.asked], t) for i, t in enumerate(types, 3)]
        self.asked.clear()
        return pa.RecordBatch.from_arrays([*columns, pa.array(f)], names=[*_REQUEST, "f"])


def part_counts(phrases: DataFrame, n_ranges: int) -> DataFrame:
    """(lang, phrase, a, cut, side, f): for every cut of every longer phrase the counts of its parts.

    ``side`` is l for the first ``cut`` words and r for the rest. Parts and phrases of one range
    of prefixes meet in one task: a transducer of the counts, composed with one of the parts of
    each portion of requests. Single words, which many phrases begin or end with, are dealt
    over ``SALTS`` ranges.
    """
    words = F.concat(F.array("lang"), F.split("phrase", " "))
    known = phrases.where("phrase IS NOT NULL").select("lang", "phrase", "f", "k", words.alias("words"))
    salts = F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    counts = known.withColumn("salt", F.explode(salts)).select(
        "words", "salt", "f", *[F.lit(None).cast(t).alias(n) for n, t in _REQUEST.items()]
    )
    longer = known.where("k > 1").withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))

    def request(side: str, part: Column) -> DataFrame:
        parts = longer.withColumn("part", F.concat(F.array("lang"), part))
        salt = F.when(F.size("part") == 2, F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
        return parts.select(
            F.col("part").alias("words"), salt.alias("salt"), F.lit(None).cast("bigint").alias("f"),
            "lang", "phrase", F.col("f").alias("a"), F.col("cut").cast("int").alias("cut"), F.lit(side).alias("side"),
        )

    asked = request("l", F.slice("words", F.lit(2), F.col("cut"))).unionByName(
        request("r", F.slice("words", F.col("cut") + 2, F.col("k")))
    )
    rows = counts.unionByName(asked).withColumn("range", _range_key(F.col("words"), F.col("salt"), n_ranges))
    names = ["range", "words", "f", *_REQUEST]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, answers = None, Answers()
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if row[0] != current or len(answers.asked) >= REQUESTS:
                    if answers.asked:
                        yield answers.give()
                    if row[0] != current:
                        current, answers = row[0], Answers()
                if row[2] is not None:
                    answers.counts[0].append(row[1])
                    answers.counts[1].append(row[2])
                else:
                    answers.asked.append(row)
        if answers.asked:
            yield answers.give()

    together = rows.select(*names).repartition("range")
    ordered = together.sortWithinPartitions("range", F.col("f").isNull())  # counts first
    schema = ", ".join(f"{name} {kind}" for name, kind in _REQUEST.items())
    return ordered.mapInArrow(run, f"{schema}, f long")


def collocations(
    docs: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of each language.

    A-Z are lower-cased; words are runs of characters other than white space and ``.,;:!?``, and
    phrases do not reach over the latter or over line ends. A phrase of 2 to ``max_words``
    words that stands ``a`` >= ``min_count`` times scores floor(1000 a n / (l r)) at the cut where
    that is least (of equal ones the first), with l and r the counts of its two parts and n the
    number of words of its language. Phrases inside a longer one with the same count are
    left out. Ties in score stand by count, then by the bytes of the phrase. Null texts are
    empty, null languages are ``und``; repeated rows count as often as they stand there.
    Fewer than ``min_count`` occurrences of everything, or no rows, give no rows.
    """
    spark = docs.sparkSession
    counted = phrase_counts(docs, lang_col, text_col, min_count, max_words)
    n_ranges = min(MAX_RANGES, max(MIN_RANGES, counted.count() // PHRASES_PER_RANGE))
    cuts = range(1, max_words)

    def count_at(cut: int, side: str) -> Column:
        return F.max(F.when((F.col("cut") == cut) & (F.col("side") == side), F.col("f"))).alias(f"{side}{cut}")

    parts = part_counts(counted, n_ranges).groupBy("lang", "phrase", "a")
    parts = written(
        parts.agg(*[count_at(cut, side) for cut in cuts for side in "lr"]), new_work_folder(spark, "parts")
    )
    totals = counted.where("phrase IS NULL").groupBy("lang").agg(F.sum("f").alias("n"))
    totals = written(totals, new_work_folder(spark, "totals"))
    size = totals.agg(F.sum(F.octet_length("lang") + 16)).first()[0] or 0
    known = parts.join(F.broadcast(totals) if size <= BROADCAST_BYTES else totals, "lang")
    exact = "decimal(38,0)"  # counts are below 10 ** 13 each, so that products fit
    scores = F.array(
        *[
            F.when(
                F.col(f"l{cut}").isNotNull(),
                F.struct(
                    F.expr(
                        f"(cast(1000 AS {exact}) * a * n) div (cast(l{cut} AS {exact}) * r{cut})"
                    ).alias("score"),
                    F.lit(cut).alias("cut"),
                    F.col(f"l{cut}").alias("l"),
                    F.col(f"r{cut}").alias("r"),
                ),
            )
            for cut in cuts
        ]
    )
    best = F.array_min(F.filter(scores, lambda s: s.isNotNull()))
    words = F.split("phrase", " ")
    n_words = F.size(words)
    first_gone = F.when(F.element_at(F.array(*[F.col(f"l{c}") for c in cuts]), n_words - 1) == F.col("a"),
                        F.array_join(F.slice(words, F.lit(1), n_words - 1), " "))
    rest_gone = F.when(F.col("r1") == F.col("a"), F.array_join(F.slice(words, F.lit(2), n_words - 1), " "))
    inside = parts.where(n_words > 2).select("lang", F.explode(F.array(first_gone, rest_gone)).alias("phrase"))
    inside = inside.where("phrase IS NOT NULL").distinct()
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        known.join(inside, ["lang", "phrase"], "left_anti")
        .withColumn("best", best)
        .select("lang", "phrase", "a", "best.l", "best.r", "n", F.col("best.score").cast("bigint").alias("score"))
        .withColumn("rank", F.row_number().over(place).cast("bigint"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
  FROM documents WHERE text IS NOT NULL),
worded AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM worded GROUP BY lang),
spread AS (
  SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM worded, (VALUES (1), (2), (3), (4), (5)) lengths(k) WHERE len(w) >= k),
counts AS (
  SELECT lang, k, w[i:i + k - 1] AS words, count(*) AS f FROM spread GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, k, words, f AS a, unnest(range(1, k)) AS cut FROM counts WHERE k > 1),
parts AS (
  SELECT c.*, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN counts l ON l.lang = c.lang AND l.words = c.words[1:cut]
  JOIN counts r ON r.lang = c.lang AND r.words = c.words[cut + 1:c.k] JOIN totals t ON t.lang = c.lang),
inside AS (
  SELECT lang, words[1:k - 1] AS words FROM parts WHERE cut = k - 1 AND l = a
  UNION SELECT lang, words[2:k] FROM parts WHERE cut = 1 AND r = a),
best AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) = 1),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank,
    array_to_string(words, ' ') AS phrase, a, l, r, n, score::BIGINT AS score
  FROM best ANTI JOIN inside USING (lang, words))
SELECT * FROM ranked WHERE rank <= 2000
"""
