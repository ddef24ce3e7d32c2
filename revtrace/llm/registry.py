"""The opN_<name> queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revtrace.llm import bpe, decontaminate, divergence, exact_dedup, html_extract, langid, license_scan, near_dup, secrets, spelling, substring_dedup, suffix_dedup, url_filter
from revtrace.llm.common import read_table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(read_table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"), keep_text=False)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, bench = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.decontaminate(docs, bench).drop("_h")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = read_table(spark, sf_dir, "documents")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN, keep_ids=False)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", langid.held_out(found["doc_id"]).alias("held_out"), "lang_pred", "score", "agreement")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"), keep_bytes=False)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_dedup(read_table(spark, sf_dir, "documents")).drop("_h")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read_table(spark, sf_dir, "pages"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read_table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [
        op1_exact_dedup, op2_secret_scan, op3_license_scan, op4_substring_dedup, op5_benchmark_decontamination, op6_byte_bpe, op7_language_id,
        op8_suffix_array_dedup, op9_minhash_near_dedup, op10_html_extraction, op11_url_filter, op12_spelling_variants, op13_source_divergence,
    ]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.ORACLE_SQL,
        "op2_secret_scan": secrets.ORACLE_SQL,
        "op4_substring_dedup": substring_dedup.ORACLE_SQL,
        "op9_minhash_near_dedup": near_dup.ORACLE_SQL,
        "op11_url_filter": url_filter.ORACLE_SQL,
        "op12_spelling_variants": spelling.ORACLE_SQL,
        "op13_source_divergence": divergence.ORACLE_SQL,
    }
