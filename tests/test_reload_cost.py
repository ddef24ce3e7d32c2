"""The reload report's cost: line items are grouped once, a key and the references to it are grouped together."""

import re

from pyspark.sql import functions as F

from support import SMALL_SF, rows
from revtrace.operators import quality
from revtrace.plans import registry, reload
from revtrace.schema import TABLES
from revtrace.session import shared_dir
from revtrace.sources.faults import with_faults
from revtrace.sources.fixtures import seed_domain
from revtrace.sources.testdata import domain_from_testdata


def both(d):
    pk = quality.check_primary_key(d).select("table_name", "constraint_name", F.lit("duplicate_key"), "violations")
    fk = quality.check_foreign_key(d).select("table_name", "constraint_name", F.lit("foreign_key"), "violations")
    return sorted(rows(pk)) + sorted(rows(fk))


def split(df):
    found = sorted(rows(df))
    return [r for r in found if r[2] == "duplicate_key"] + [r for r in found if r[2] == "foreign_key"]


def test_keys_and_references_together_equal_both_checks(spark):
    d = with_faults(domain_from_testdata(spark, SMALL_SF))
    got = split(quality.check_keys(d))
    assert got == both(d)
    assert sum(r[3] > 0 for r in got) >= 4
    assert len(got) == len(TABLES) + sum(len(t.foreign_keys) for t in TABLES.values())


def test_null_keys_and_null_references(spark):
    seeds = seed_domain(spark)
    pick = F.rand(7)
    holed = {
        t: seeds[t].unionByName(seeds[t].select(*[F.when(pick < 0.5, F.col(c.name)).alias(c.name) for c in TABLES[t].columns]))
        for t in ("ponto_coleta", "lote_coleta", "lote_triado", "processo_reciclagem")
    }
    d = seeds.replace(**{t: spark.createDataFrame(df.collect(), df.schema) for t, df in holed.items()})
    got = split(quality.check_keys(d))
    assert got == both(d)
    assert any(r[3] for r in got)


def test_empty_tables_have_no_violations(spark):
    seeds = seed_domain(spark)
    d = seeds.replace(**{t: seeds[t].limit(0) for t in TABLES})
    assert all(r[3] == 0 for r in split(quality.check_keys(d)))


def test_no_table_is_joined_to_find_orphans(spark):
    plan = quality.check_keys(seed_domain(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_line_items_are_grouped_once(spark, monkeypatch):
    grouped, staged = [], reload.write_table

    def write(df, root, table, mode="overwrite"):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        grouped.extend([table] * len(re.findall(r"Aggregate \[l_orderkey#\d+L?, l_linenumber", plan)))
        staged(df, root, table, mode)

    monkeypatch.setattr(reload, "write_table", write)
    assert registry.full_reload_report(spark, SMALL_SF).count() == 16
    assert not grouped  # the tables are derived from the written groups

    d = domain_from_testdata(spark, SMALL_SF)
    for table in ("lote_triado", "processo_reciclagem", "material_processado"):
        write(d[table], f"{shared_dir(spark, 'groups-test')}", table)
    assert len(grouped) == 3  # each on its own works them out
