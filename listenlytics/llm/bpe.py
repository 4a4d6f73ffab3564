"""Byte-level BPE: merges of a rank file replayed over a corpus, and decoding.

The distinct pieces of a slice of the corpus are laid out as one array of symbols. An
inverted index gives for each rank (a pair of neighbours whose joined bytes have that rank)
the positions where the pair stands; ranks are taken in ascending order from a heap, all
positions of a rank are merged from left to right, and only the two neighbours of a merged
position look up their new rank. A slice is up to ``SLICE_BYTES`` of pieces that the task has not
met lately; those it has are remembered, at most ``2 * CACHE_PIECES``. Joining the pieces of every
document with one table for the whole corpus would shuffle several times the text for the same ids.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import map_texts
from .words import small_batches

CACHE_PIECES = 250_000
CACHE_PAIRS = 200_000
SLICE_BYTES = 1 << 16
GROUP_CHARS = 1 << 18
PORTION_PIECES = 1 << 16
MAX_VOCABULARY_BYTES = 64 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one line for each token, its bytes in base64 and its id."""
    with open(path, "rb") as file:
        content = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(content) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is larger than a vocabulary may be to be broadcast")
    lines = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class MergeReplay:
    """Encodes many pieces together by replaying the merges in rank order."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[int, int] = {}  # by left << 32 | right
        self.first_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        byte_pairs = [ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)]
        self.first_ranks = np.array(byte_pairs, np.int64).reshape(256, 256)

    def _look_up(self, left: int, right: int) -> int:
        """The rank of a pair that is not remembered, -1 without one."""
        rank = self.ranks.get(self.token[left] + self.token[right], -1)
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        self.pairs[left << 32 | right] = rank
        return rank

    def _first_index(self, symbols: np.ndarray) -> dict[int, list[int]]:
        """Rank to positions for the pairs of single bytes."""
        byte_of = np.full(int(self.first_ids.max()) + 2, -1, np.int64)
        byte_of[self.first_ids] = np.arange(256)
        single = byte_of[symbols]  # -1, the end of a piece, reads the last entry
        ranks = self.first_ranks[single[:-1], single[1:]]
        ranks[(single[:-1] < 0) | (single[1:] < 0)] = -1
        order = np.argsort(ranks, kind="stable")
        order = order[np.searchsorted(ranks[order], 0) :]
        found, first = np.unique(ranks[order], return_index=True)
        return {
            int(rank): places.tolist()
            for rank, places in zip(found, np.split(order, first[1:]), strict=False)
        }

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece, packed as little-endian unsigned 32-bit integers."""
        if not pieces:
            return []
        look_up, known = self._look_up, self.pairs.get
        data = np.frombuffer(b"".join(pieces), np.uint8)
        piece_ends = np.cumsum([len(piece) for piece in pieces], dtype=np.int64)
        symbols = np.insert(self.first_ids[data], piece_ends, -1)  # no pair reaches over an end
        ids = symbols.tolist()
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        index = self._first_index(symbols)
        heap = list(index)
        heapq.heapify(heap)

        while heap:
            rank = heapq.heappop(heap)
            places = index.pop(rank)
            places.sort()
            for done, position in enumerate(places):
                left = ids[position]
                if left < 0:
                    continue
                follower = after[position]
                right = ids[follower]
                if right < 0:
                    continue
                found = known(left << 32 | right)
                if (look_up(left, right) if found is None else found) != rank:
                    continue
                ids[position], ids[follower] = rank, -2
                behind = after[follower]
                after[position], before[behind] = behind, position
                ahead = before[position]
                for at, a, b in ((ahead, ids[ahead] if ahead >= 0 else -1, rank), (position, rank, ids[behind])):
                    if a < 0 or b < 0:
                        continue
                    found = known(a << 32 | b)
                    if found is None:
                        found = look_up(a, b)
                    if found >= 0:
                        if found in index:
                            index[found].append(at)
                        else:
                            index[found] = [at]
                            heapq.heappush(heap, found)
                if heap and heap[0] < rank:  # a merge that comes first; go on with this rank later
                    rest = places[done + 1 :]
                    if rest:
                        if rank not in index:
                            heapq.heappush(heap, rank)
                        index.setdefault(rank, []).extend(rest)
                    break
        flat = np.array(ids, np.int64)
        keep = flat >= 0
        packed = flat[keep].astype("<u4").tobytes()
        ends = piece_ends + np.arange(1, len(pieces) + 1)
        cuts = np.concatenate(([0], np.cumsum(keep)))[np.concatenate(([0], ends))] * 4
        return [packed[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


class Encoder:
    """Encodes texts, remembering the pieces it met lately in two generations."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.pattern = regex.compile(pattern)
        self.replay = MergeReplay(ranks)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids_of(self, pieces: set[str]) -> dict[str, bytes]:
        known: dict[str, bytes] = {}
        new: list[str] = []
        size = 0

        def learn() -> None:
            known.update(zip(new, self.replay.encode([p.encode() for p in new]), strict=True))
            new.clear()

        for piece in pieces:
            ids = self.young.get(piece) or self.old.get(piece)
            if ids is None:
                new.append(piece)
                size += len(piece)
                if size >= SLICE_BYTES:
                    learn()
                    size = 0
            else:
                known[piece] = ids
        learn()
        self.young.update(known)
        if len(self.young) > CACHE_PIECES:
            self.young, self.old = {}, self.young
        return known

    def _long(self, text: str) -> bytes:
        """The ids of one long text, a portion of its pieces after the other."""
        pieces = (match[0] for match in self.pattern.finditer(text))
        ids = []
        while portion := list(islice(pieces, PORTION_PIECES)):
            known = self._ids_of(set(portion))
            ids.append(b"".join([known[piece] for piece in portion]))
        return b"".join(ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The packed ids of each text; null texts have none."""
        found: list[bytes] = []
        group: list[list[str]] = []
        chars = 0

        def finish() -> None:
            known = self._ids_of({piece for one in group for piece in one})
            found.extend([b"".join([known[piece] for piece in one]) for one in group])
            group.clear()

        for text in texts:
            if text and len(text) > GROUP_CHARS:
                finish()
                found.append(self._long(text))
                continue
            group.append(self.pattern.findall(text) if text else [])
            chars += len(text or "")
            if chars >= GROUP_CHARS:
                finish()
                chars = 0
        finish()
        return found


class Decoder:
    """The bytes that packed ids stand for."""

    def __init__(self, ranks: dict[bytes, int]):
        by_id = sorted((rank, token) for token, rank in ranks.items())
        self.lengths = np.zeros(by_id[-1][0] + 1, np.int64)
        self.lengths[[rank for rank, _ in by_id]] = [len(token) for _, token in by_id]
        self.offsets = np.concatenate(([0], np.cumsum(self.lengths)))
        self.content = np.frombuffer(b"".join(token for _, token in by_id), np.uint8)

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, "<u4")
        size = self.lengths[ids]
        ends = np.cumsum(size)
        shift = np.repeat(self.offsets[ids] - (ends - size), size)
        return self.content[shift + np.arange(len(shift))].tobytes()


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_decoded: bool = False,
) -> DataFrame:
    """``id_col`` and ``ids``: the token ids of each text, packed little-endian uint32.

    ``vocabulary`` is the path of a rank file that the driver can read, ``pattern`` splits a
    text into pieces that merge on their own. ``with_decoded`` adds what the ids decode to.
    Null and empty texts have no ids (an empty binary). One row for each input row, repeated
    rows and null ids included.
    """
    spark = docs.sparkSession
    table = read_ranks(vocabulary)
    ranks = spark.sparkContext.broadcast(table)

    def start():
        encoder = Encoder(ranks.value, pattern)  # lives as long as the task
        decoder = Decoder(ranks.value) if with_decoded else None

        def make(column: pa.Array) -> list[pa.Array]:
            ids = encoder.encode(column.to_pylist())
            columns = [pa.array(ids, pa.binary())]
            if decoder:
                columns.append(pa.array([decoder.decode(one) for one in ids], pa.binary()))
            return columns

        return make

    fields = "ids binary, decoded binary" if with_decoded else "ids binary"
    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return map_texts(named, "_text", fields, start, ["_id"]).withColumnRenamed("_id", id_col)


def decode(tokens: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` and ``decoded``: the bytes that the packed ids stand for; null ids give none."""
    spark = tokens.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary))
    names = tokens.columns
    schema = T.StructType([*tokens.schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(ranks.value)
        for batch in batches:
            packed = batch.column(names.index(ids_col)).to_pylist()
            decoded = [decoder.decode(one or b"") for one in packed]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], names=[*names, "decoded"]
            )

    return tokens.mapInArrow(run, schema)


def token_digests(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token counts and digests of ids and of decoded bytes, a round trip for each text."""
    return encode(docs, vocabulary, pattern, id_col, text_col, with_decoded=True).select(
        id_col,
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[str, str]:
    """Path and splitting pattern of a vocabulary file of this machine."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN
