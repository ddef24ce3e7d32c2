"""Hot keys: one transport / one point holding most rows, checked by brute force."""

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from support import rows
from revtrace.operators import reports
from revtrace.sources.fixtures import SEED_ROWS, seed_domain

N_LOTS = 600


def _skewed(spark):
    sc = ("Av. Trabalhador Sao-carlense, 400", "Sao Carlos", "13566590", "SP")
    lots = list(SEED_ROWS["lote_coleta"])
    lt = list(SEED_ROWS["lote_triado"])
    pr = list(SEED_ROWS["processo_reciclagem"])
    mp = list(SEED_ROWS["material_processado"])
    for i in range(10, 10 + N_LOTS):
        # two thirds of the lots at one point, on one first-leg transport
        hot = i % 3 != 0
        point = sc if hot else ("Av. Paulista, 1000", "Sao Paulo", "01310100", "SP")
        lots.append((i, *point, dt.date(2026, 1, 1) + dt.timedelta(days=i), "TR-001" if hot else "TR-002"))
        # sorted lots: almost all dispatched on TR-004
        lt.append((i, f"PIN-{i}", "Linha Verde", Decimal(i % 7 + 1), dt.date(2026, 6, 1), "TR-004" if hot else "TR-003"))
        if i % 5 == 0:
            day = dt.date(2026, 7, 1) + dt.timedelta(days=i)
            pr.append((day, "Fusao", i, f"PIN-{i}"))
            mp.append(("Cobre", day, "Fusao", Decimal(1), None, None, "77777777000177"))
    return seed_domain(
        spark,
        {"lote_coleta": lots, "lote_triado": lt, "processo_reciclagem": pr, "material_processado": mp},
    ), lots, lt, pr, mp


def test_skewed_reports_match_brute_force(no_broadcast):
    spark = no_broadcast
    d, lots, lt, pr, mp = _skewed(spark)
    ttr = {c: centre for c, centre, _ in SEED_ROWS["transporte_tri_reciclagem"]}

    # R3: volume per centre
    vol = defaultdict(Decimal)
    for _, _, _, peso, _, transport in lt:
        if transport is not None:
            vol[ttr[transport]] += peso
    got = {r[0]: r[3] for r in rows(reports.volume_by_centre(d))}
    assert got == dict(vol)
    mean_x_n = sum(vol.values())
    above = {c for c, v in vol.items() if v * len(vol) > mean_x_n}
    assert {r[0] for r in rows(reports.centres_above_average(d))} == above

    # R4: points behind Cobre (many lots per point)
    processes = {(day, kind): lot for day, kind, lot, _ in pr}
    lot_point = {r[0]: r[1:5] for r in lots}
    expect = {lot_point[processes[(day, kind)]] for m, day, kind, *_ in mp if m == "Cobre"}
    assert {r for r in rows(reports.trace_origin_by_material(d, "Cobre"))} == expect

    # R2: unsorted transported lots (none: every lot has a sorted lot)
    assert rows(reports.lots_without_sorting(d)) == []

    # R1: still exactly the seed's complete centre
    assert [r[0] for r in rows(reports.relational_division(d))] == ["33333333000133"]


def test_hot_key_join_is_split_and_exact(no_broadcast):
    """Two thirds of the lots share one transport: AQE splits that key."""
    from revtrace.operators import relational

    spark = no_broadcast
    d, lots, *_ = _skewed(spark)
    tct = {c for c, _ in SEED_ROWS["transporte_coleta_tri"]}
    expected = sum(1 for r in lots if r[6] in tct)
    df = relational.join_inner_single_key(d)
    assert len(df.collect()) == expected
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan


def test_hot_right_key_of_the_outer_join_is_split(no_broadcast):
    """Two thirds of the sorted lots at one lot, the others once each, some lots never sorted."""
    spark = no_broadcast
    from pyspark.sql import functions as F

    from revtrace.operators import relational
    from revtrace.schema import TABLE_NAMES
    from revtrace.sources.domain import Domain

    lots = spark.range(300).select(F.col("id").alias("id_lote"))
    hot = spark.range(0, 20000, 1, 4).select(F.lit(7).cast("long").alias("lote_coleta"), F.concat(F.lit("PIN"), "id").alias("pin_lote_tri"))
    cold = spark.range(0, 10000, 1, 4).select((F.col("id") % 200).alias("lote_coleta"), F.concat(F.lit("P"), "id").alias("pin_lote_tri"))
    seeds = seed_domain(spark)
    d = Domain.of(spark, {t: seeds[t] for t in TABLE_NAMES} | {"lote_coleta": lots, "lote_triado": hot.unionByName(cold)})
    out = relational.join_left_outer(d)
    got = out.groupBy("id_lote").agg(F.count("pin_lote_tri").alias("n"), F.count("*").alias("rows")).collect()
    counts = {r.id_lote: (r.n, r.rows) for r in got}
    assert counts == {k: (20050, 20050) if k == 7 else (50, 50) if k < 200 else (0, 1) for k in range(300)}
    out.collect()
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
