"""Seed rows of the domain as DataFrames (literal-rows source).

Used by the unit tests: the expected report outputs on these rows are
known by reading, which makes them golden fixtures.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from revtrace.schema import TABLES
from revtrace.sources.domain import Domain


def _d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def _n(s: str) -> Decimal:
    return Decimal(s)


# The 49 seed rows of the domain, in declared column order.
SEED_ROWS: dict[str, list[tuple]] = {
    "categoria": [
        ("Linha Verde", "Equipamentos de informática, celulares e tablets"),
        ("Linha Branca", "Geladeiras, freezers, máquinas de lavar e micro-ondas"),
        ("Linha Marrom", "Monitores, televisores e equipamentos de áudio e vídeo"),
    ],
    "ponto_coleta": [
        ("Av. Trabalhador Sao-carlense, 400", "Sao Carlos", "13566590", "SP", _n("500.00")),
        ("Av. Paulista, 1000", "Sao Paulo", "01310100", "SP", _n("1500.00")),
        ("Praca da Savassi, S/N", "Belo Horizonte", "30140000", "MG", _n("800.00")),
    ],
    "centro_triagem": [
        ("11111111000111", "Triagem Central Interior SC", "Rua Alfa, 10", "Sao Carlos", "13560000", "SP"),
        ("22222222000122", "EcoTriagem Capital SP", "Rua Beta, 20", "Sao Paulo", "01000000", "SP"),
    ],
    "centro_reciclagem": [
        ("33333333000133", "Recicla Tudo Industrial", "Rua Gama, 30", "Campinas", "13000000", "SP", "LIC-REC-001-SP"),
        ("44444444000144", "Metais Verdes Processamento", "Rua Delta, 40", "Guarulhos", "07000000", "SP", "LIC-REC-002-SP"),
    ],
    "transportadora": [
        ("55555555000155", "Logistica Reversa Express", "ANTT-12345"),
        ("66666666000166", "EcoTrans Transportes Verdes", "ANTT-67890"),
    ],
    "material": [
        ("Cobre", "Metal Comum"),
        ("Ouro", "Metal Precioso"),
        ("Litio", "Critico"),
        ("Cobalto", "Critico"),
        ("Neodimio", "Critico"),
        ("Plastico ABS", "Polimero"),
    ],
    "organizacao_destino": [
        ("77777777000177", "Industria Metalurgica S.A."),
        ("88888888000188", "Plasticos Renovaveis Ltda."),
    ],
    "dispositivo_eletronico": [
        ("Smartphone Generico", _n("0.20"), "Linha Verde"),
        ("Notebook 15 polegadas", _n("2.00"), "Linha Verde"),
        ("Geladeira 2 Portas", _n("60.00"), "Linha Branca"),
        ("Monitor LCD 24 pol", _n("3.50"), "Linha Marrom"),
    ],
    "transporte": [
        ("TR-001", "55555555000155", _d("2026-05-10"), _d("2026-05-10"), "ABC1234", "Coleta-Tri"),
        ("TR-002", "66666666000166", _d("2026-05-15"), _d("2026-05-16"), "XYZ9876", "Coleta-Tri"),
        ("TR-003", "55555555000155", _d("2026-05-20"), _d("2026-05-21"), "ABC1234", "Tri-Reciclagem"),
        ("TR-004", "66666666000166", _d("2026-05-22"), _d("2026-05-23"), "XYZ9876", "Tri-Reciclagem"),
    ],
    "transporte_coleta_tri": [
        ("TR-001", "11111111000111"),
        ("TR-002", "22222222000122"),
    ],
    "transporte_tri_reciclagem": [
        ("TR-003", "33333333000133", "MTR-SP-1001"),
        ("TR-004", "44444444000144", "MTR-SP-1002"),
    ],
    "lote_coleta": [
        (1, "Av. Trabalhador Sao-carlense, 400", "Sao Carlos", "13566590", "SP", _d("2026-05-08"), "TR-001"),
        (2, "Av. Paulista, 1000", "Sao Paulo", "01310100", "SP", _d("2026-05-12"), "TR-002"),
    ],
    "qtd_produto_lote": [
        (1, "Smartphone Generico", _n("50")),
        (1, "Notebook 15 polegadas", _n("10")),
        (2, "Geladeira 2 Portas", _n("5")),
        (2, "Smartphone Generico", _n("100")),
    ],
    "lote_triado": [
        (1, "PIN-1-VERDE", "Linha Verde", _n("30.50"), _d("2026-05-12"), "TR-003"),
        (2, "PIN-2-BRANCA", "Linha Branca", _n("305.00"), _d("2026-05-18"), "TR-004"),
        (2, "PIN-2-VERDE", "Linha Verde", _n("20.20"), _d("2026-05-18"), "TR-004"),
    ],
    "processo_reciclagem": [
        (_d("2026-05-22"), "Desmontagem Manual", 1, "PIN-1-VERDE"),
        (_d("2026-05-23"), "Refino Quimico", 1, "PIN-1-VERDE"),
        (_d("2026-05-25"), "Trituracao", 2, "PIN-2-BRANCA"),
    ],
    "material_processado": [
        ("Cobre", _d("2026-05-22"), "Desmontagem Manual", _n("5.00"), _d("2026-05-26"), "Comercializacao", "77777777000177"),
        ("Litio", _d("2026-05-23"), "Refino Quimico", _n("0.50"), _d("2026-05-27"), "Comercializacao", "77777777000177"),
        ("Cobalto", _d("2026-05-23"), "Refino Quimico", _n("0.20"), _d("2026-05-27"), "Comercializacao", "77777777000177"),
        ("Neodimio", _d("2026-05-23"), "Refino Quimico", _n("0.10"), _d("2026-05-27"), "Comercializacao", "77777777000177"),
        ("Plastico ABS", _d("2026-05-25"), "Trituracao", _n("50.00"), _d("2026-05-28"), "Reutilizacao", "88888888000188"),
    ],
}


def frames(
    spark: SparkSession, rows: dict[str, list[tuple]] | None = None
) -> dict[str, object]:
    data = rows if rows is not None else SEED_ROWS
    return {t: spark.createDataFrame(data[t], TABLES[t].spark_schema) for t in TABLES}


def seed_domain(
    spark: SparkSession, overrides: dict[str, list[tuple]] | None = None
) -> Domain:
    """The seed domain, with whole tables replaced by ``overrides``."""
    rows = {**SEED_ROWS, **(overrides or {})}
    return Domain.of(spark, frames(spark, rows))
