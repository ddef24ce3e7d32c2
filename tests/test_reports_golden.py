"""Reports on the 49 seed rows; expected rows derived by reading them."""

from decimal import Decimal

from support import rows
from revtrace.operators import listings, reports


def test_relational_division(seeds):
    assert rows(reports.relational_division(seeds)) == [
        ("33333333000133", "Recicla Tudo Industrial", "Campinas", "SP")
    ]


def test_lots_without_sorting_empty(seeds):
    assert rows(reports.lots_without_sorting(seeds)) == []


def test_centres_above_average(seeds):
    out = rows(reports.centres_above_average(seeds))
    assert out == [
        ("44444444000144", "Metais Verdes Processamento", "LIC-REC-002-SP", Decimal("325.20"))
    ]
    vols = {r[0]: r[3] for r in rows(reports.volume_by_centre(seeds))}
    assert vols == {"33333333000133": Decimal("30.50"), "44444444000144": Decimal("325.20")}


def test_trace_origin(seeds):
    sc = [("Av. Trabalhador Sao-carlense, 400", "Sao Carlos", "13566590", "SP")]
    assert rows(reports.trace_origin_by_material(seeds, "Cobre")) == sc
    assert rows(reports.trace_origin_by_material(seeds, "Litio")) == sc
    assert rows(reports.trace_origin_by_material(seeds, "Plastico ABS")) == [
        ("Av. Paulista, 1000", "Sao Paulo", "01310100", "SP")
    ]
    assert rows(reports.trace_origin_by_material(seeds, "Ouro")) == []
    assert rows(reports.trace_origin_by_material(seeds, "cobre")) == []


def test_carrier_mean_transit(seeds):
    assert rows(reports.carrier_mean_transit(seeds)) == [
        ("55555555000155", "Logistica Reversa Express", 0.0),
        ("66666666000166", "EcoTrans Transportes Verdes", 1.0),
    ]


def test_listings(seeds):
    assert [r[1] for r in rows(listings.list_collection_points(seeds))] == [
        "Belo Horizonte",
        "Sao Carlos",
        "Sao Paulo",
    ]
    assert [r[0] for r in rows(listings.list_materials(seeds))] == [
        "Cobalto",
        "Cobre",
        "Litio",
        "Neodimio",
        "Ouro",
        "Plastico ABS",
    ]
    assert [r[0] for r in rows(listings.list_lots(seeds))] == [1, 2]


def test_option_labels(seeds):
    labels = {(r[0], r[1]): r[2] for r in rows(listings.option_labels(seeds))}
    assert labels[("lot", "1")] == "#1 — Sao Carlos/SP (2026-05-08)"
    assert labels[("device", "Geladeira 2 Portas")] == "Geladeira 2 Portas (Linha Branca, 60 kg)"
    assert labels[("material", "Litio")] == "Litio — Critico"


def test_listing_collation(spark):
    from revtrace.sources.fixtures import SEED_ROWS, seed_domain

    mats = SEED_ROWS["material"] + [("Épsilon", "Comum"), ("Zinco", "Comum")]
    d = seed_domain(spark, {"material": mats})
    binary = [r[0] for r in rows(listings.list_materials(d))]
    unicode_ = [r[0] for r in rows(listings.list_materials(d, collation="UNICODE"))]
    assert binary[-1] == "Épsilon"  # bytewise: after 'Z'
    assert unicode_.index("Épsilon") < unicode_.index("Litio")


def test_append_accepted_reports_affected_rows(spark):
    from revtrace.operators import ingest
    from revtrace.session import shared_dir
    from revtrace.sources.fixtures import seed_domain
    from revtrace.sources.store import read_table

    d = seed_domain(spark)
    sub = spark.createDataFrame(
        [(1, "Rua A", "X", "1", "sp", "1"), (2, "Rua B", "X", "2", "sp", "x")],
        "submit_seq long, rua string, cidade string, cep string, estado string, capacidade_max string",
    )
    res = ingest.ingest_points(sub, d.ponto_coleta)
    root = shared_dir(spark, "append-test")
    assert ingest.append_accepted(res, root, "ponto_coleta", "first") == 1
    assert read_table(spark, root, "ponto_coleta").count() == 1


def test_register_views_for_sql(spark, seeds):
    seeds.register_views(prefix="seed_")
    out = spark.sql(
        """
        SELECT tr.cnpj, round(avg(datediff(t.data_chegada, t.data_envio)), 2) AS media
        FROM seed_transportadora tr
        JOIN seed_transporte t ON tr.cnpj = t.transportadora
        WHERE EXISTS (SELECT 1 FROM seed_transporte_coleta_tri c WHERE c.cod_rastreio = t.cod_rastreio)
        GROUP BY tr.cnpj ORDER BY tr.cnpj
        """
    )
    assert [(r[0], float(r[1])) for r in out.collect()] == [
        ("55555555000155", 0.0),
        ("66666666000166", 1.0),
    ]


def test_material_parameter_is_stripped_and_required(seeds):
    import pytest

    from revtrace.operators import reports

    assert rows(reports.trace_origin_by_material(seeds, " Cobre\t")) == rows(reports.trace_origin_by_material(seeds, "Cobre"))
    for blank in ("", " \t\n", None):
        with pytest.raises(ValueError):
            reports.trace_origin_by_material(seeds, blank)


def test_option_keys_are_json(seeds):
    import json

    keys = [r[1] for r in rows(listings.option_labels(seeds)) if r[0] == "point"]
    assert keys and all(set(json.loads(k)) == {"rua", "cidade", "cep", "estado"} for k in keys)
