"""From raw documents to tokens: five stages, each over all that the one before kept.

Quality rules drop documents that they reject, the Jaccard join keeps one document of each
group of near copies, decontamination drops documents with a benchmark passage, the secret
scan masks what it finds, and byte-level BPE encodes and decodes what is left.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from listenlytics.llm.benchmarks import without_contaminated  # noqa: E402
from listenlytics.llm.bpe import encode, public_vocabulary  # noqa: E402
from listenlytics.llm.jaccard import one_of_each  # noqa: E402
from listenlytics.llm.secrets import mask_secrets  # noqa: E402
from listenlytics.llm.weakrules import keep_good  # noqa: E402
from listenlytics.session import new_work_folder  # noqa: E402
from listenlytics.staging import written  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base check and the weighed rules."""
    return keep_good(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component, linked by five-word shingles at 0.8."""
    return one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their secrets masked, and their length counted again."""
    return mask_secrets(docs).withColumn("n_chars", F.char_length("text").cast("bigint"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, packed as little-endian uint32, and the round trip's digests."""
    vocabulary, pattern = public_vocabulary()
    return encode(docs, vocabulary, pattern, with_decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE", byte_bpe),
]

#: Weak supervision, components and merges are iterative, so there is no SQL for the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), new_work_folder(spark, f"stage-{place}"))
    return docs
