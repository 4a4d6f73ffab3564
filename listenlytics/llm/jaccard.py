"""Exact Jaccard join of documents by pivots.

Pivots of the first level are single shingles, ordered from rare to frequent. The distance
from a set to the pivot {s} is smallest for its own shingles, and among these the order
decides, so a document's home is the region of its rarest shingle. Of two documents within
the distance limit t, neither can lack more than t of the larger one's shingles, so in the
order their first common shingle stands within the first |A| - ceil((1 - t) |A|) + 1 of
each: that is the window of regions into which a document is replicated, and every pair
within the limit meets in one of them.

A region of at most ``SMALL`` members is gathered in one row and compared in pairs. A larger one
recurses with document pivots: all members are compared with 4 * 16 ** round pivots, members
known to be connected need no further comparison, the pivots leave, and what remains
is the next, smaller region, until what is left of all crowds is few for their members and is
compared in pairs. Pivots are the members whose window has the fewest shingles before the
region's: of near copies of one text that is the text itself, since what a copy changes
is rare and stands first. The members of a crowd are dealt over ``SALTS`` tasks, and its pivots
go to all of them. Before any sets are moved, each pair has to pass the
triangle inequality on the parts of the hash range: a part where |A in part| and |B in part|
differ in parity holds a shingle that one of them lacks, so such parts are at most
|A - B| + |B - A|. There are as many parts as a set has shingles, to the next power of two.

Exact copies are one class, so they are never compared with one another.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..session import new_work_folder
from ..staging import in_few_files, written
from .components import components
from .frames import map_texts
from .words import shingle_hashes, small_batches, text_blocks

SHINGLE = 3
PERCENT = 90
SMALL = 24
FIRST_PIVOTS, GROWTH = 4, 16
SALTS = 16
PAIRS_PER_MEMBER, PAIRS_LATER = FIRST_PIVOTS, 256
LEAST_PARTS = 64
COUNTERS = 1 << 23
LOCAL_TOP, GLOBAL_TOP = 1 << 16, 1 << 18
BROADCAST_BYTES = 32 << 20


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text, as hashes; shorter texts are one shingle."""
    for first, last, block in text_blocks(column, lower=True):
        words = block.hashes()
        shingles = shingle_hashes(words, size)
        for i in range(last - first):
            a, b = block.word_of[i], block.word_of[i + 1]
            if b - a >= size:
                yield np.unique(shingles[a : b - size + 1])
            elif b > a:
                yield shingle_hashes(words[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield np.zeros(0, np.uint64)


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.md5(shingles.tobytes(), usedforsecurity=False).digest()


def _signature(shingles: np.ndarray) -> bytes:
    """The parity of the number of shingles in each part, a bit for each."""
    parts = max(LEAST_PARTS, 1 << (len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(parts - 1)).astype(np.int64), minlength=parts)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64(COUNTERS - 1)).astype(np.int64)


def _described(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(_id, n_shingles, key, signature) of every row, and counters in the same pass.

    The counters are rows with only ``counter`` and ``total``: for each task the
    ``LOCAL_TOP`` most frequent of its shingles' counters.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            counts, keys, signatures = [], [], []
            for shingles in shingle_sets(batch.column(1), size):
                counts.append(len(shingles))
                keys.append(_key(shingles))
                signatures.append(_signature(shingles))
                np.add.at(totals, _counter(shingles), 1)
            nothing = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    nothing,
                    nothing,
                ],
                names=schema.names,
            )
        top = np.flatnonzero(totals > 1)
        if len(top) > LOCAL_TOP:
            top = top[np.argpartition(totals[top], -LOCAL_TOP)[-LOCAL_TOP:]]
        columns = [pa.nulls(len(top), t) for t in (id_type, pa.int64(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(top, pa.int64()), pa.array(totals[top], pa.int64())],
            names=schema.names,
        )

    named = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    small_batches(docs.sparkSession)
    schema = T.StructType.fromDDL(
        "n_shingles long, key binary, signature binary, counter long, total long"
    )
    schema = T.StructType([named.schema["_id"], *schema.fields])
    id_type = to_arrow_type(named.schema["_id"].dataType)
    return named.mapInArrow(describe, schema)


def _frequent(described: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counters of shingles that are frequent in some part of the corpus, with their sums.

    They only set the order of the shingles, so that crowded shingles come last; any order
    gives the same links. At most ``GLOBAL_TOP`` sums come to the driver.
    """
    rows = (
        described.where("counter IS NOT NULL")
        .groupBy("counter")
        .agg(F.sum("total").alias("total"))
        .orderBy(F.desc("total"), "counter")
        .limit(GLOBAL_TOP)
        .toPandas()
    )
    return rows["counter"].to_numpy(), rows["total"].to_numpy()


def _least_overlap(n: int, percent: int) -> int:
    """The shingles that a set of ``n`` shares at least with a partner within the limit."""
    return -(-percent * n // 100)


def _windows(
    docs: DataFrame, text_col: str, size: int, percent: int, frequent: tuple[np.ndarray, np.ndarray]
) -> DataFrame:
    """(region, key, n, place): each document's window of regions in their order.

    ``n`` is the document's number of shingles. Copies in a batch come once.
    """
    order = docs.sparkSession.sparkContext.broadcast(frequent)  # ``GLOBAL_TOP`` entries at most

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, totals = order.value
        weight = np.zeros(COUNTERS, np.int32)
        weight[counters] = np.minimum(totals, np.iinfo(np.int32).max)
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            regions, keys, sizes, places, seen = [], [], [], [], set()
            for shingles in shingle_sets(batch.column(0), size):
                key = _key(shingles)
                n = len(shingles)
                if n == 0 or key in seen:
                    continue
                seen.add(key)
                window = n - _least_overlap(n, percent) + 1
                ranked = np.lexsort((shingles, weight[_counter(shingles)]))[:window]
                regions.append(shingles[ranked].view(np.int64))
                places.append(np.arange(window))
                keys += [key] * window
                sizes.append(np.full(window, n))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([nothing, *regions])),
                    pa.array(keys, pa.binary()),
                    pa.array(np.concatenate([nothing, *sizes])),
                    pa.array(np.concatenate([nothing, *places])),
                ],
                names=["region", "key", "n", "place"],
            )

    text = docs.select(F.col(text_col).cast("string").alias("text"))
    return text.mapInArrow(replicate, "region long, key binary, n long, place long")


def _may_link(percent: int, field: Callable[[str], Column] = F.col) -> Column:
    """Whether sizes and places of two members of a region allow a link.

    In the region of their first common shingle, all common ones stand at or behind its
    place in both, so neither may have fewer left than a link needs.
    """
    n_a, n_b = field("n_a"), field("n_b")
    sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent
    left = F.least(n_a - field("place_a"), n_b - field("place_b"))
    return sizes & (left * (100 + percent) >= (n_a + n_b) * percent)


def _is_early(percent: int) -> Column:
    """Whether a member's place allows a link with one of its own size.

    Of two that link, the larger one's partner is no larger than it, so by ``_may_link`` the
    smaller one has enough left for twice its own size. Every pair has such a member.
    """
    left = F.col("n") - F.col("place")
    return (100 + percent) * left >= 2 * percent * F.col("n")


def _shared_regions(windows: DataFrame, percent: int) -> DataFrame:
    """(region, crowded) of the regions that two documents may link in.

    Those with at most ``SMALL`` rows, copies in several batches included, are not crowded. A row is told from others by its size, its place and 32 bits that are drawn anew for each
    region, packed into one number, so that little is shuffled. Of a region with two rows, which
    most are, the least and the greatest number give both sizes and places; those too large
    for their bits may link with all.
    """
    bits_n, bits_place = 20, 12
    n, place = (
        F.least(F.col(name), F.lit((1 << bits) - 1)) for name, bits in (("n", bits_n), ("place", bits_place))
    )
    mark = F.xxhash64("key", "region").bitwiseAND((1 << 32) - 1)
    packed = F.shiftleft(n, 32 + bits_place).bitwiseOR(F.shiftleft(place, 32)).bitwiseOR(mark)
    found = windows.groupBy("region").agg(
        F.count("*").alias("rows"), F.min(packed).alias("least"), F.max(packed).alias("greatest")
    )
    two = {}
    for side, row in (("a", "least"), ("b", "greatest")):
        two[f"n_{side}"] = F.shiftrightunsigned(row, 32 + bits_place)
        two[f"place_{side}"] = F.shiftrightunsigned(row, 32).bitwiseAND((1 << bits_place) - 1)
    huge = (F.col("n_b") == (1 << bits_n) - 1) | (F.col("place_a") == (1 << bits_place) - 1)
    huge = huge | (F.col("place_b") == (1 << bits_place) - 1)
    possible = (F.col("rows") > 2) | huge | _may_link(percent)
    return found.where("least != greatest").withColumns(two).where(possible).select(
        "region", (F.col("rows") > SMALL).alias("crowded")
    )


def _pairs_of_small(windows: DataFrame, regions: DataFrame, percent: int) -> DataFrame:
    """Pairs (key_a, key_b) that may link, of regions with ``SMALL`` rows at most.

    The rows are moved once; a region's few members are then paired in its own row.
    """
    rows = windows.join(_small_enough(regions), "region", "left_semi").repartition("region")
    members = F.array_sort(F.collect_set(F.struct("key", "n", "place"))).alias("members")

    def paired(a: Column, i: Column) -> Column:
        def pair(b: Column) -> Column:
            return F.struct(*[m[c].alias(f"{c}_{s}") for s, m in (("a", a), ("b", b)) for c in ("key", "n", "place")])

        return F.transform(F.slice("members", i + 2, F.size("members")), pair)

    pairs = F.filter(F.flatten(F.transform("members", paired)), lambda p: _may_link(percent, p.getField))
    return rows.groupBy("region").agg(members).select(F.inline(pairs)).select("key_a", "key_b")


def _small_enough(df: DataFrame) -> DataFrame:
    """With a broadcast hint when the rows of a written table are few bytes; else it is shuffled."""
    widths = [F.octet_length(F.col(f.name).cast("binary")) if isinstance(f.dataType, (T.StringType, T.BinaryType))
              else F.lit(8) for f in df.schema.fields]
    size = df.agg(F.sum(sum(widths, F.lit(24)))).first()[0]  # 24 for a row's place in the hash table
    return F.broadcast(df) if (size or 0) <= BROADCAST_BYTES else df


def _signature_passes(a: pa.Scalar, b: pa.Scalar, n: int, percent: int) -> bool:
    """Whether |A - B| + |B - A|, by its lower bound, may be small enough; ``n`` is |A| + |B|."""
    few, many = sorted((np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b)), key=len)
    while len(many) > len(few):  # parts of half as many are the sums of two
        many = many[: len(many) // 2] ^ many[len(many) // 2 :]
    apart = int(np.bitwise_count(few ^ many).sum())
    return apart * (100 + percent) <= n * (100 - percent)


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (key_a, key_b) whose signatures do not rule out a link."""
    side = {
        s: classes.select(
            F.col("key").alias(f"key_{s}"), F.col("rep").alias(f"rep_{s}"),
            F.col("n_shingles").alias(f"n_{s}"), F.col("signature").alias(f"signature_{s}"),
        )
        for s in "ab"
    }
    right = side["b"].join(_small_enough(pairs.select("key_b")), "key_b", "left_semi")
    known = side["a"].join(_small_enough(pairs), "key_a").join(right, "key_b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(4), batch.column(5), batch.column(6).to_pylist(), strict=True)
            keep = [_signature_passes(a, b, n, percent) for a, b, n in rows]
            yield batch.select([0, 1, 2, 3]).filter(pa.array(keep, pa.bool_()))

    columns = ("key_a", "key_b", "rep_a", "rep_b", "signature_a", "signature_b")
    checked = known.select(*columns, (F.col("n_a") + F.col("n_b")).alias("n"))
    return checked.mapInArrow(check, T.StructType(checked.schema.fields[:4]))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) among the pairs, by their whole sets."""
    left = sets.select(F.col("key").alias("key_a"), F.col("shingles").alias("shingles_a"))
    right = sets.select(F.col("key").alias("key_b"), F.col("shingles").alias("shingles_b"))
    right = right.join(_small_enough(pairs.select("key_b")), "key_b", "left_semi")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    whole = left.join(_small_enough(pairs), "key_a").join(right, "key_b")
    both = whole.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"), "shingles_a", "shingles_b")
    return both.mapInArrow(check, T.StructType(both.schema.fields[:2]))


def _connected(links: DataFrame, n_links: int) -> DataFrame:
    """(node, label) of the linked nodes; nodes with one label are connected, though not the reverse.

    The label is the least node within two steps, which joins a star to its centre's least
    neighbour. Whole components are worked out once, at the end.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    near = written(in_few_files(near, 2 * n_links), new_work_folder(links.sparkSession, "near"))
    beside = both.join(_small_enough(near.withColumnRenamed("a", "b")), "b").select("a", "least")
    return (
        beside.unionByName(near).groupBy(F.col("a").alias("node")).agg(F.min("least").alias("label"))
    )


def _sets_of(
    docs: DataFrame, id_col: str, text_col: str, size: int, wanted: DataFrame
) -> DataFrame:
    """(key, shingles) of the ``wanted`` (key, rep), worked out from their texts again.

    Only the representatives' texts are read anew, so no sets of other documents are kept
    or moved. A representative that stands on several rows gives its set several times.
    """

    def start():
        def make(column: pa.Array) -> list[pa.Array]:
            sets = list(shingle_sets(column, size))
            return [
                pa.array([_key(s) for s in sets], pa.binary()),
                pa.array([s.tobytes() for s in sets], pa.binary()),
            ]

        return make

    named = docs.select(F.col(id_col).alias("rep"), F.col(text_col).alias("_text"))
    theirs = named.join(_small_enough(wanted.select("rep").distinct()), "rep", "left_semi")
    found = map_texts(theirs, "_text", "key binary, shingles binary", start, [])
    return found.join(_small_enough(wanted.select("key")), "key", "left_semi")


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """(``id_col``, n_shingles, component_id) of every row.

    Two documents link when their sets of ``size``-word shingles have 100 * intersection >=
    ``percent`` * union; component_id is the smallest id reachable over links. Words are runs
    of non-space, A-Z lower-cased. Null and empty texts have no shingles, link with nothing
    and are their own component. Rows without an id keep a null component and link nothing.
    One row for each input row; repeated rows share their class.
    """
    spark = docs.sparkSession

    def kept(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
        df = df if rows is None else in_few_files(df, rows)
        return written(df, new_work_folder(spark, label))

    table = kept(_described(docs, id_col, text_col, size), "described")
    described = table.where("counter IS NULL").drop("counter", "total")
    n_docs = described.count()
    classes = kept(
        described.where("n_shingles > 0 AND _id IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("_id").alias("rep"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("signature").alias("signature"),
        ),
        "classes",
        n_docs,
    )
    names = classes.select("key", "rep")
    with_id = docs.where(F.col(id_col).isNotNull())
    windows = kept(_windows(with_id, text_col, size, percent, _frequent(table)), "windows")
    n_windows = windows.count()
    shared = kept(_shared_regions(windows, percent), "regions", n_windows // 2)
    of_small = _pairs_of_small(windows, shared.where("NOT crowded"), percent)
    crowds = shared.where("crowded")
    members = windows.join(_small_enough(crowds), "region", "left_semi").join(names, "key")
    # by key and then all of the row, so that the join's partitioning serves
    members = members.groupBy("key", "region", "rep", "n", "place").agg(F.lit(True).alias("once")).drop("once")
    members = kept(members, "members", n_windows)

    id_type = docs.schema[id_col].dataType
    links = spark.createDataFrame([], T.StructType([T.StructField(n, id_type) for n in "ab"]))
    labels = None
    n_members, n_links, turn = members.count(), 0, 0
    while True:
        labelled = members.withColumn("label", F.col("rep"))
        if labels is not None:
            of_rep = _small_enough(labels.withColumnRenamed("node", "rep"))
            labelled = members.join(of_rep, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
        counts = labelled.groupBy("region").agg(
            F.count("*").alias("size"),
            F.count_if(_is_early(percent)).alias("n_early"),
            F.min("label").alias("low"),
            F.max("label").alias("high"),
        )
        open_regions = counts.where("low != high AND n_early > 0").select("region", "size", "n_early")
        current = kept(labelled.join(open_regions, "region"), "current", n_members)
        open_rows = current.agg(
            F.count("*").alias("rows"),
            F.sum(F.when(F.col("size") > SMALL, F.col("n_early"))).alias("crowd_pairs"),
        ).first()
        if turn and not open_rows["rows"]:
            break
        # what is left of the crowds is compared in pairs as soon as these are few for the members
        last = (open_rows["crowd_pairs"] or 0) <= (PAIRS_LATER if turn else PAIRS_PER_MEMBER) * n_members
        in_crowd = F.col("size") > SMALL
        columns = ("key", "n", "place", "label", "early")
        salt = F.when(in_crowd, F.pmod(F.xxhash64("key"), F.lit(SALTS))).otherwise(F.lit(0))
        salts = F.when(in_crowd, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        dealt = current.withColumns({"salt": salt.cast("int"), "salts": salts, "early": _is_early(percent)})
        crowded = dealt.where(F.lit(not last) & in_crowd)
        rest = dealt.where(F.lit(last) | ~in_crowd)
        first = rest.where("early").select("region", "salts", *columns, F.lit(False).alias("pivot"))
        if not last:
            rank = F.row_number().over(Window.partitionBy("region").orderBy("place", "n", "key"))
            pivots = kept(
                crowded.where("early")
                .withColumn("rank", rank)
                .where(F.col("rank") <= FIRST_PIVOTS * GROWTH**turn)
                .select("region", "salts", *columns, F.lit(True).alias("pivot")),
                "pivots",
                n_members,
            )
            first = first.unionByName(pivots)
        a = first.select(
            "region", F.explode("salts").alias("salt"), "pivot", *[F.col(c).alias(f"{c}_a") for c in columns]
        )
        b = dealt.select("region", "salt", *[F.col(c).alias(f"{c}_b") for c in columns])
        pairs = (
            a.join(b, ["region", "salt"])
            .where("label_a != label_b AND (pivot OR NOT early_b OR key_a < key_b)")
            .where(_may_link(percent))
            .select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b"))
        )
        most = open_rows["crowd_pairs"] or 0
        if not last:
            most = min(most, FIRST_PIVOTS * GROWTH**turn * open_rows["rows"])
        most += SMALL * open_rows["rows"]
        if not turn:
            pairs = pairs.unionByName(of_small)
            most += n_windows
        pairs = kept(pairs.distinct(), "pairs", most)
        plausible = kept(_plausible(pairs, classes, percent), "plausible", pairs.count())
        n_plausible = plausible.count()
        sides = [plausible.select(F.col(f"key_{s}").alias("key"), F.col(f"rep_{s}").alias("rep")) for s in "ab"]
        wanted = kept(sides[0].unionByName(sides[1]).distinct(), "wanted", 2 * n_plausible)
        sets = kept(_sets_of(with_id, id_col, text_col, size, wanted), "sets")
        found = kept(_verified(plausible, sets, percent), "found", n_plausible)
        links, n_links = links.unionByName(found), n_links + found.count()
        if last:
            break
        labels = kept(_connected(links, n_links), "near-labels", 2 * n_links)
        members = crowded.join(pivots, ["region", "key"], "left_anti").select(
            "region", "key", "rep", "n", "place"
        )
        turn += 1
    labels = kept(components(links, n_links=n_links), "labels", 2 * n_links)
    result = described.join(names, "key", "left").join(
        labels.withColumnRenamed("node", "rep"), "rep", "left"
    )
    own = F.when(F.col("n_shingles") == 0, F.col("_id")).otherwise(F.coalesce("component", "rep"))
    named = result.select(
        F.col("_id").alias(id_col),
        "n_shingles",
        F.when(F.col("_id").isNotNull(), own).alias("component_id"),
    )
    return in_few_files(named, n_docs)


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row of each component, the one with the smallest id, with its own columns only.

    Rows that share an id are one document: it stays if it is the smallest of a component
    by any of its texts, and one of its rows stays. Rows without an id all stay.
    """
    spark = docs.sparkSession
    found = jaccard_components(docs, id_col, text_col, size, percent)
    found = written(found.select(F.col(id_col).alias("_id"), "component_id"), new_work_folder(spark, "found"))
    judged = found.where("_id IS NOT NULL").groupBy("_id").agg(
        F.max(F.col("_id") == F.col("component_id")).alias("stays"), F.count("*").alias("rows")
    )
    judged = in_few_files(judged.where("NOT stays OR rows > 1"), found.count())
    judged = written(judged, new_work_folder(spark, "judged"))
    gone = _small_enough(judged.where("NOT stays").select(F.col("_id").alias(id_col)))
    several = _small_enough(judged.where("stays").select(F.col("_id").alias(id_col)))
    left = docs.join(gone, id_col, "left_anti")
    if several.isEmpty():
        return left
    once = left.join(several, id_col, "left_anti")
    again = left.join(several, id_col, "left_semi").dropDuplicates([id_col])
    return once.unionByName(again).select(*docs.columns)


COMPONENTS_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
spread AS (
  SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM worded WHERE len(w) > 0),
sets AS (SELECT DISTINCT doc_id, w[i:i + 2] AS shingle FROM spread),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 90 * (x.n + y.n - s.n)),
reach(a, b) AS (
  SELECT a, b FROM links
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id
"""
