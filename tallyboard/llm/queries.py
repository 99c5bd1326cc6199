"""Each operator as a query over the test tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import class_lm, collocations, decontaminate, exact_dedup, jaccard_join, language_id, licenses, mixing, quality_rules, secret_scan, suffix_dedup, token_alignment, warc
from .common import table


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "n_links", "kept")


def op2_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_texts(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), kept=False).drop("kept")


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_pages(table(spark, sf_dir, "pages"))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at", "range", "place")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("leaked"), F.array_sort("item_ids").alias("item_ids"), F.array_max("scores").alias("similarity"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train_network(docs))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_class_lm": op2_class_lm,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_warc_archive": op4_warc_archive,
    "op5_secret_scan": op5_secret_scan,
    "op6_license_scan": op6_license_scan,
    "op7_decontaminate": op7_decontaminate,
    "op8_mix_sources": op8_mix_sources,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_language_id": op10_language_id,
    "op11_token_alignment": op11_token_alignment,
    "op12_collocations": op12_collocations,
    "op13_quality_rules": op13_quality_rules,
}

ORACLES = {
    "op8_mix_sources": mixing.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_quality_rules": quality_rules.ORACLE,
}
