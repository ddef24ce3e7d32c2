"""Edge fixtures: the seed rows with one change each."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from support import rows
from revtrace.operators import quality, reports
from revtrace.sources.fixtures import SEED_ROWS, seed_domain


def test_x1_no_critical_material_every_centre_qualifies(spark):
    mats = [(n, "Comum") for n, _ in SEED_ROWS["material"]]
    d = seed_domain(spark, {"material": mats})
    assert len(rows(reports.relational_division(d))) == 2


def test_x2_centre_without_transport(spark):
    extra = SEED_ROWS["centro_reciclagem"] + [
        ("99999999000199", "Centro Vazio", "Rua Z", "Campinas", "13000001", "SP", "LIC-9")
    ]
    d = seed_domain(spark, {"centro_reciclagem": extra})
    assert [r[0] for r in rows(reports.relational_division(d))] == ["33333333000133"]
    assert [r[0] for r in rows(reports.centres_above_average(d))] == ["44444444000144"]


def _with_lot3(spark, arrival: str):
    transports = SEED_ROWS["transporte"] + [
        ("TR-005", "55555555000155", dt.date(2026, 5, 20), dt.date.fromisoformat(arrival), "ABC1234", "Coleta-Tri")
    ]
    tct = SEED_ROWS["transporte_coleta_tri"] + [("TR-005", "11111111000111")]
    lots = SEED_ROWS["lote_coleta"] + [
        (3, "Praca da Savassi, S/N", "Belo Horizonte", "30140000", "MG", dt.date(2026, 5, 19), "TR-005"),
        (4, "Praca da Savassi, S/N", "Belo Horizonte", "30140000", "MG", dt.date(2026, 5, 21), None),
    ]
    return seed_domain(
        spark, {"transporte": transports, "transporte_coleta_tri": tct, "lote_coleta": lots}
    )


@pytest.mark.parametrize("arrival", ["2026-05-21", "2099-01-01"])
def test_x3_x4_lot_without_sorting(spark, arrival):
    d = _with_lot3(spark, arrival)
    out = rows(reports.lots_without_sorting(d))
    assert out == [
        (3, dt.date(2026, 5, 19), "Belo Horizonte", "Triagem Central Interior SC", dt.date.fromisoformat(arrival))
    ]


def test_x5_equal_volumes_return_nothing(spark):
    lt = [
        (1, "PIN-1-VERDE", "Linha Verde", Decimal("100.00"), dt.date(2026, 5, 12), "TR-003"),
        (2, "PIN-2-BRANCA", "Linha Branca", Decimal("60.00"), dt.date(2026, 5, 18), "TR-004"),
        (2, "PIN-2-VERDE", "Linha Verde", Decimal("40.00"), dt.date(2026, 5, 18), "TR-004"),
    ]
    d = seed_domain(spark, {"lote_triado": lt})
    assert rows(reports.centres_above_average(d)) == []


def test_x6_single_centre_returns_nothing(spark):
    lt = [r for r in SEED_ROWS["lote_triado"] if r[5] == "TR-004"]
    d = seed_domain(spark, {"lote_triado": lt})
    assert rows(reports.centres_above_average(d)) == []


def test_x7_two_lots_of_one_point_give_one_row(spark):
    lots = SEED_ROWS["lote_coleta"] + [
        (5, "Av. Trabalhador Sao-carlense, 400", "Sao Carlos", "13566590", "SP", dt.date(2026, 5, 9), None)
    ]
    lt = SEED_ROWS["lote_triado"] + [
        (5, "PIN-5", "Linha Verde", Decimal("1.00"), dt.date(2026, 5, 12), None)
    ]
    pr = SEED_ROWS["processo_reciclagem"] + [(dt.date(2026, 5, 26), "Fusao", 5, "PIN-5")]
    mp = SEED_ROWS["material_processado"] + [
        ("Cobre", dt.date(2026, 5, 26), "Fusao", Decimal("1.00"), None, None, "77777777000177")
    ]
    d = seed_domain(
        spark,
        {"lote_coleta": lots, "lote_triado": lt, "processo_reciclagem": pr, "material_processado": mp},
    )
    assert len(rows(reports.trace_origin_by_material(d, "Cobre"))) == 1


def test_seed_constraints_all_zero(seeds):
    for check in (
        quality.check_not_null,
        quality.check_length,
        quality.check_primary_key,
        quality.check_unique,
        quality.check_foreign_key,
    ):
        df = check(seeds)
        assert df.agg(F.sum("violations")).first()[0] == 0, check.__name__


def test_x8_delete_transport_sets_lot_null(seeds):
    plan = quality.plan_delete(seeds, "transporte", seeds.transporte.filter(F.col("cod_rastreio") == "TR-001"))
    summary = {(r[0], r[1]): r[2] for r in rows(plan.summary())}
    assert summary[("transporte", "deleted")] == 1
    assert summary[("transporte_coleta_tri", "deleted")] == 1
    assert summary[("lote_coleta", "set_null")] == 1
    new = quality.execute_delete(plan)
    lots = {r[0]: r[6] for r in rows(new["lote_coleta"])}
    assert lots == {1: None, 2: "TR-002"}
    assert [r[0] for r in rows(new["transporte_coleta_tri"])] == ["TR-002"]


def test_x9_delete_lot_cascades(seeds):
    plan = quality.plan_delete(seeds, "lote_coleta", seeds.lote_coleta.filter(F.col("id_lote") == 2))
    summary = {(r[0], r[1]): r[2] for r in rows(plan.summary())}
    assert summary == {
        ("lote_coleta", "deleted"): 1,
        ("qtd_produto_lote", "deleted"): 2,
        ("lote_triado", "deleted"): 2,
        ("processo_reciclagem", "deleted"): 1,
        ("material_processado", "deleted"): 1,
    }
    new = quality.execute_delete(plan)
    assert sorted(r[0] for r in rows(new["material_processado"])) == ["Cobalto", "Cobre", "Litio", "Neodimio"]


def test_x10_delete_category_refused(seeds):
    plan = quality.plan_delete(seeds, "categoria", seeds.categoria.filter(F.col("nome") == "Linha Verde"))
    blocking = sorted(rows(plan.blocking))
    assert blocking == [
        ("dispositivo_eletronico", "fk_disp_categoria", "categoria", 2),
        ("lote_triado", "fk_lote_triado_categoria", "categoria", 2),
    ]
    with pytest.raises(quality.DeleteRefused):
        quality.execute_delete(plan)


def test_x11_delete_material_cascades(seeds):
    plan = quality.plan_delete(seeds, "material", seeds.material.filter(F.col("nome") == "Cobre"))
    new = quality.execute_delete(plan)
    assert "Cobre" not in [r[0] for r in rows(new["material_processado"])]
    assert len(rows(new["material_processado"])) == 4


def test_cascade_not_blocked_by_rows_deleted_in_same_plan(seeds):
    # deleting a lot removes its sorted lots; their NO ACTION category FK
    # must not refuse the delete
    plan = quality.plan_delete(seeds, "lote_coleta", seeds.lote_coleta)
    assert plan.blocking.isEmpty()


def test_transport_unified(seeds):
    out = {r[0]: (r[4], r[5], r[6]) for r in rows(quality.transport_unified(seeds))}
    assert out["TR-001"] == ("coleta_triagem", "11111111000111", None)
    assert out["TR-004"] == ("triagem_reciclagem", "44444444000144", "MTR-SP-1002")


def test_injected_faults_are_found(spark):
    from revtrace.sources.testdata import domain_from_testdata
    from revtrace.sources.faults import with_faults

    d = with_faults(domain_from_testdata(spark, "/root/testdata/sf0.001"))
    nn = {r[1]: r[2] for r in rows(quality.check_not_null(d))}
    assert nn["nn_ponto_coleta_capacidade_max"] > 0
    assert nn["nn_lote_triado_categoria"] > 0
    fk = {r[1]: r[3] for r in rows(quality.check_foreign_key(d))}
    assert fk["fk_lote_triado_transporte"] > 0
    assert fk["fk_qtd_dispositivo"] > 0
    assert fk["fk_lote_ponto_coleta"] > 0
