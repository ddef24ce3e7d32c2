import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls everywhere, empty and very long texts, repeated rows and clashing extra columns."""

    def build(texts, more=()):
        rows = [(k if k % 11 else None, t) for k, t in enumerate(texts, 1)]
        rows += [*rows[2:4], *more, (500, None), (None, None), (501, ""), (502, " \n\t "), (None, ""), (503, "word " * 9000)]
        df = spark.createDataFrame(rows, "doc_id long, text string")
        names = ["_id", "_h", "_text", "_set", "_key", "_digest", "_row", "kept", "score", "_lettered", "_cut", "_rows"]
        return df.select("*", *[F.lit(n).alias(n) for n in names])

    return build


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
