"""Row identity and small helpers shared by the operators.

Document identity: a row is identified by its id together with a hash of its
text. Rows that repeat both are copies of one document: they get the same
result, one output row each. Null ids and null texts are ordinary values (a
null text counts as empty).

Column names used inside the operators start with ``_``, and only the columns
an operator needs are selected first, so extra columns of the input (whatever
their names) never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import revtrace.llm
from revtrace.session import ensure_checkpoint_dir, materialize

__all__ = [
    "BLOOM",
    "WORD",
    "arrow_rows",
    "bloom_filters",
    "carried",
    "ensure_checkpoint_dir",
    "keyed",
    "lower_ascii",
    "materialize",
    "read_table",
    "text_of",
]

#: Spark's runtime Bloom filter: 4 MB; with more keys than it is sized for it lets more rows pass, never fewer.
BLOOM = {
    "enabled": "true",
    "applicationSideScanSizeThreshold": "16MB",
    "creationSideThreshold": "1GB",
    "expectedNumItems": "4000000",
    "numBits": str(32 << 20),
}
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(col, UPPER, UPPER.lower())


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, _text): the row's id, a hash of its text, and the text, null as ''."""
    text = text_of(text_col)
    return df.select(F.col(f"`{id_col}`").alias("_id"), F.xxhash64(text).alias("_h"), text.alias("_text"))


def carried(df: DataFrame, **extra: Column) -> DataFrame:
    """All columns of ``df`` as one struct ``_row`` beside the given ones; unpack with ``select("_row.*")``."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
    return df.select(row, *[c.alias(name) for name, c in extra.items()])


def text_of(text_col: str) -> Column:
    """The text, null as ''."""
    return F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))


def arrow_rows(spark: SparkSession, rows: int = 1000) -> None:
    """Keep the Arrow batches handed to Python small, so long texts fit in memory.

    The functions that run on executors are shipped with the tasks, so the
    package need not be installed there.
    """
    cloudpickle.register_pickle_by_value(revtrace.llm)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


@contextmanager
def bloom_filters(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Joins by a shuffle drop what cannot match in front of it, also below Spark's usual sizes. The filter has a fixed size."""
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    wanted = BLOOM | settings
    old = {prefix + k: spark.conf.get(prefix + k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(prefix + k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
