"""Read the sixteen tables from a relational database over JDBC.

Source tables use the unquoted CamelCase names of the DDL, which the
database folds to lower case (``PontoColeta.CapacidadeMax`` is
``pontocoleta.capacidademax``); the catalogue names are the same words in
snake case, so the source name is the catalogue name without underscores.

Large tables should be read in parallel: pass ``partitions`` with an
integer column and its bounds per table (``spark.read.jdbc`` splits the
range into ``num_partitions`` concurrent queries). Blank-padded CHAR
values are right-trimmed and every column is cast to its catalogue type.

Not exercised by the tests (no database server is available to them).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrace.schema import TABLE_NAMES, TABLES
from revtrace.sources.domain import Domain


@dataclass(frozen=True)
class JdbcSplit:
    column: str  # catalogue column name, e.g. "id_lote"
    lower: int
    upper: int
    num_partitions: int


def source_name(name: str) -> str:
    return name.replace("_", "")


def read_table_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split: JdbcSplit | None = None,
) -> DataFrame:
    t = TABLES[table]
    if split is None:
        raw = spark.read.jdbc(url, source_name(table), properties=properties)
    else:
        raw = spark.read.jdbc(
            url,
            source_name(table),
            column=source_name(split.column),
            lowerBound=split.lower,
            upperBound=split.upper,
            numPartitions=split.num_partitions,
            properties=properties,
        )
    cols = []
    for c in t.columns:
        v = F.col(source_name(c.name))
        if c.kind == "char":
            v = F.rtrim(v)
        cols.append(v.cast(c.spark_type).alias(c.name))
    return raw.select(*cols)


def read_domain_jdbc(
    spark: SparkSession,
    url: str,
    properties: dict[str, str],
    partitions: dict[str, JdbcSplit] | None = None,
) -> Domain:
    splits = partitions or {}
    return Domain(
        spark,
        {
            t: (lambda t=t: read_table_jdbc(spark, url, t, properties, splits.get(t)))
            for t in TABLE_NAMES
        },
    )
