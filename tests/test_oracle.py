"""Every registered query against its DuckDB SQL on the smallest test scale."""

import pytest

from support import SMALL_SF
from revtrace.plans.crosscheck import compare, duckdb_connection
from revtrace.plans.oracle import oracle_sql
from revtrace.plans.registry import queries

KEYS = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SMALL_SF)


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    result = compare(queries()[key](spark, SMALL_SF), con, oracle_sql()[key])
    assert result["ok"], result


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["cnpj", "nome", "licenca_ambiental", "volume_total"]
    assert df.count() >= 0


@pytest.mark.parametrize("key", sorted(k for k in queries() if k != "ingest_stream"))
def test_outputs_use_engine_neutral_types(spark, key):
    from pyspark.sql import types as T

    df = queries()[key](spark, SMALL_SF)
    for f in df.schema.fields:
        assert not isinstance(f.dataType, (T.DecimalType, T.DateType, T.TimestampType)), (key, f)
