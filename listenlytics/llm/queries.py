"""The operators on the given tables, one callable for each query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .benchmarks import contaminations
from .bpe import public_vocabulary, token_digests
from .chats import CHATS_SQL, chat_digests
from .collocations import COLLOCATIONS_SQL, collocations
from .gam import quality_scores
from .hosts import JUDGE_SQL, judge_urls
from .jaccard import COMPONENTS_SQL, jaccard_components
from .licenses import SCAN_SQL, license_scan
from .pages import extract_pages
from .periodic import run_digests
from .secrets import secret_spans
from .toxicity import toxicity_scores
from .weakrules import quality_verdicts

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the label of its id: good when of quality and not toxic."""
    outcomes = _table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    )
    return judge_urls(_table(spark, sf_dir, "pages"), outcomes)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(_table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items in each document; word spans, ends exclusive."""
    return contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(_table(spark, sf_dir, "documents"))
    spans = F.transform(
        "found", lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))
    )

    def count(kind: str):
        return F.size(F.filter(F.split("base", ","), lambda s: s.startswith(f"{kind}:"))).cast("bigint")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2("base", 256).alias("base_sha256"),
        F.concat_ws(",", spans).alias("spans"),
    )


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_table(spark, sf_dir, "documents"), *public_vocabulary())


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every text, where those of a tenth of the ids are made to repeat a stretch."""
    return run_digests(_table(spark, sf_dir, "documents"))


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, with control strings of another template in its texts."""
    table = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    one_more = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat_digests(table.unionByName(one_more))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_html_extraction": op2_html_extraction,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_quality_rules": op4_quality_rules,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_secret_scans": op7_secret_scans,
    "op8_toxicity": op8_toxicity,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_license_scans": op10_license_scans,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_phrase_collocations": op13_phrase_collocations,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filter": JUDGE_SQL,
    "op6_ngram_jaccard_join": COMPONENTS_SQL,
    "op10_license_scans": SCAN_SQL,
    "op12_chat_formatting": CHATS_SQL,
    "op13_phrase_collocations": COLLOCATIONS_SQL,
}
