"""Domain tables stored as Parquet: typed reads and writes.

Reads always pass the catalogue schema (never inferred), so a stored table
with a drifted type fails at read time instead of silently changing a
report.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from revtrace.schema import TABLE_NAMES, TABLES
from revtrace.sources.domain import Domain


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def valid_run(run_id: str) -> str:
    """The id of a run, which becomes part of a folder's name."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    return run_id


def run_path(root: str, table: str, run_id: str) -> str:
    """The folder of the rows that one run added to a table."""
    return f"{table_path(root, table)}/run-{valid_run(run_id)}"


def read_path(spark: SparkSession, path: str | list[str], table: str) -> DataFrame:
    """A stored table, of one folder or several: its own files and those of the runs added to it."""
    reader = spark.read.schema(TABLES[table].spark_schema).option("recursiveFileLookup", "true")
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_path(spark, table_path(root, table), table)


def read_domain(spark: SparkSession, root: str) -> Domain:
    return Domain(
        spark, {t: (lambda t=t: read_table(spark, root, t)) for t in TABLE_NAMES}
    )


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the catalogue columns in order, cast to their declared types."""
    return df.select(
        *[df[c.name].cast(c.spark_type).alias(c.name) for c in TABLES[table].columns]
    )


def write_table(df: DataFrame, root: str, table: str, mode: str = "overwrite") -> None:
    conform(df, table).write.mode(mode).parquet(table_path(root, table))


# Fixed layout choice: the lot-keyed tables and the column holding the lot id.
# Bucketing all four by lot id into the same number of buckets makes the joins
# and aggregations on the lot id (lots without sorting, lineage, lot FKs,
# cascades from a lot) run without shuffling either side.
LOT_KEYED = {
    "lote_coleta": "id_lote",
    "lote_triado": "lote_coleta",
    "processo_reciclagem": "lote_coleta",
    "qtd_produto_lote": "lote",
}


def write_domain(
    d: Domain,
    root: str,
    lot_buckets: int | None = None,
    database: str = "revtrace",
) -> Domain:
    """Write all sixteen tables under ``root`` and return them read back.

    With ``lot_buckets`` the lot-keyed tables are written as bucketed
    catalog tables (``bucketBy(lot_buckets, lot id)``, data under ``root``)
    so later joins on the lot id are co-partitioned; the other tables are
    plain Parquet.
    """
    spark = d.spark
    if lot_buckets:
        spark.sql(
            f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{root.rstrip('/')}/_catalog'"
        )
    frames = {}
    for t in TABLE_NAMES:
        df = conform(d[t], t)
        if lot_buckets and t in LOT_KEYED:
            key = LOT_KEYED[t]
            name = f"{database}.{t}"
            (
                df.write.mode("overwrite")
                .bucketBy(lot_buckets, key)
                .sortBy(key)
                .option("path", table_path(root, t))
                .saveAsTable(name)
            )
            frames[t] = spark.table(name)
        else:
            df.write.mode("overwrite").parquet(table_path(root, t))
            frames[t] = read_table(spark, root, t)
    return Domain.of(spark, frames)
