"""A training corpus from raw documents: five stages, each written before the next reads it.

Every stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame: the columns of ``documents`` for all stages but the last,
which returns the token ids.

1. language: documents that are null, without letters, or in none of the
   learned languages go;
2. exact dedup: one row of each group of equal texts stays;
3. near-dedup: one document of each group of near copies stays;
4. decontamination: documents that hold a benchmark item go;
5. byte-level BPE: token ids, with the hash of the decoded bytes as a round-trip check.

Nulls, empty tables and extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revtrace.llm import bpe, decontaminate, exact_dedup, langid, near_dup
from revtrace.llm.common import materialize, read_table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs, langid.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("language", language),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("decontaminate", decontaminated),
    ("encode", tokens),
]

# A trained network decides the first stage, which SQL cannot express: the
# tests check the rows against a brute-force version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
