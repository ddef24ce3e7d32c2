"""Exact deduplication with skew-safe combining.

Texts are equal when identical after lower-casing A-Z. The combining (:func:`combine`)
runs in three stages, so that a text with many copies costs one row per task and no
task gets them all:

1. every task combines its own rows (the partial aggregate in front of the first shuffle);
2. what is left is merged under a salt, the task's number, so copies found in many
   tasks spread over ``salts`` groups;
3. the salt winners are combined globally, dealt out by digest: at most ``salts`` rows per text.

It runs twice. First by digest alone, for the winner and the count of each digest; no text is
moved for that, and a digest that one row holds is settled. Then by digest *and* full
content, for every digest that more than one row holds: the texts themselves are compared,
whatever the digest. Spark's runtime Bloom filter of those digests keeps the other texts
from being shuffled. A digest that is found to hold several texts (never seen for SHA-256, but allowed for
any digest function) is resolved by a join on the content; in the others, every row finds its winner by a
join on the digest.

Nothing here runs Python on the executors.

Defined results: a null text counts as empty. ``keep_id`` is the largest
non-null id of the group, null if there is none. Rows repeating id and text are
copies like any others: they count in ``group_size`` and share one result. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revtrace.llm.common import bloom_filters, carried, lower_ascii, materialize, text_of
from revtrace.session import lean_writes

#: The Bloom filter is built from a table of digests up to this size; beyond it, every task's distinct texts are shuffled.
DIGESTS = "1TB"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _content(df: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    rows = df.select(F.col(f"`{id_col}`").alias("_id"), lower_ascii(text_of(text_col)).alias("_norm"))
    return rows.withColumn("_digest", digest(F.col("_norm")))


def combine(rows: DataFrame, salts: int, content: Sequence[str] = (), among: DataFrame | None = None) -> DataFrame:
    """One row per distinct digest and ``content``: both, keep_id, group_size; only of the digests of ``among``, if given."""
    salt = F.pmod(F.spark_partition_id(), F.lit(salts))
    local = (
        rows.groupBy("_digest", salt.alias("_salt"), *content)
        .agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .drop("_salt")
    )
    local = local.repartition("_digest") if among is None else local.join(among, "_digest", "left_semi")
    return local.groupBy("_digest", *content).agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))


def _several(texts: DataFrame) -> DataFrame:
    """The digests that hold several texts."""
    return texts.groupBy("_digest").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").drop("_texts")


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 32,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    rows = _content(df, id_col, text_col, digest)
    winners = materialize(combine(rows, salts), "exact-dedup")
    # the texts of one digest are compared in full, wherever there is more than one
    texts = combine(rows, salts, ["_norm"], winners.where("group_size > 1").select("_digest"))
    with bloom_filters(df.sparkSession, creationSideThreshold=DIGESTS), lean_writes(df.sparkSession):
        differ = _several(texts).agg(F.count(F.lit(1))).first()[0]
    slim = rows if digest is not sha256 else rows.drop("_norm")
    if not differ:
        out = slim.join(winners, "_digest")
    else:
        texts = materialize(texts, "exact-dedup-texts")
        shared = materialize(_several(texts), "exact-dedup-shared")
        mixed = rows.join(shared, "_digest", "left_semi").join(texts, ["_digest", "_norm"])
        out = slim.join(winners.join(shared, "_digest", "left_anti"), "_digest")
        out = out.unionByName(mixed.select(*out.columns))
    text_sha = F.col("_digest") if digest is sha256 else F.sha2("_norm", 256)
    return out.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        text_sha.alias("text_sha256"),
    )


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, that stay: exactly one row of each group of equal texts."""
    found = exact_dedup(df, id_col, text_col).where("kept")
    keep = found.groupBy(F.col(id_col).alias("_kid"), F.col("text_sha256").alias("_sha")).agg(F.count(F.lit(1)).alias("_rows"))
    keep = materialize(keep, "exact-dedup-keep")
    rows = carried(df, _id=F.col(f"`{id_col}`"), _digest=sha256(lower_ascii(text_of(text_col))))
    rows = rows.join(keep, (F.col("_digest") == F.col("_sha")) & F.col("_id").eqNullSafe(F.col("_kid")))
    # Rows that repeat id and text cannot be told apart by them: of these, any one stays.
    once = rows.where("_rows = 1").unionByName(rows.where("_rows > 1").dropDuplicates(["_digest"]))
    return once.select("_row.*")


ORACLE_SQL = """
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, t, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
      FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
            FROM documents))
"""
