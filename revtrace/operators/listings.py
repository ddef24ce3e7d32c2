"""Catalogue listings (scan + project + sort) and the form option labels.

Full listings, no paging, in the source order with the primary key appended
as the last sort key so the order is total. Text sorts bytewise (Spark's
default collation).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrace.sources.domain import Domain


def _asc(*cols: str, collation: str | None = None):
    """Ascending, NULLs last. Text sorts bytewise unless a collation is
    given (e.g. ``"UNICODE"`` puts accented letters next to their base)."""
    out = []
    for c in cols:
        col = F.col(c)
        if collation is not None:
            col = F.collate(col, collation)
        out.append(col.asc_nulls_last())
    return out


def list_collection_points(d: Domain, collation: str | None = None) -> DataFrame:
    return d.ponto_coleta.select("rua", "cidade", "cep", "estado").orderBy(
        *_asc("cidade", "rua", "cep", "estado", collation=collation)
    )


def list_devices(d: Domain, collation: str | None = None) -> DataFrame:
    return d.dispositivo_eletronico.select("nome", "peso_medio", "categoria").orderBy(
        *_asc("nome", collation=collation)
    )


def list_lots(d: Domain) -> DataFrame:
    return d.lote_coleta.select("id_lote", "data_coleta", "cidade", "estado").orderBy(
        *_asc("id_lote")
    )


def list_materials(d: Domain, collation: str | None = None) -> DataFrame:
    return d.material.select("nome", "tipo_material").orderBy(*_asc("nome", collation=collation))


def list_sorting_centres(d: Domain, collation: str | None = None) -> DataFrame:
    return d.centro_triagem.select("cnpj", "nome", "cidade").orderBy(
        *_asc("nome", "cnpj", collation=collation)
    )


def list_recycling_centres(d: Domain, collation: str | None = None) -> DataFrame:
    return d.centro_reciclagem.select(
        "cnpj", "nome", "cidade", "licenca_ambiental"
    ).orderBy(*_asc("nome", "cnpj", collation=collation))


def list_carriers(d: Domain, collation: str | None = None) -> DataFrame:
    return d.transportadora.select("cnpj", "nome").orderBy(*_asc("nome", "cnpj", collation=collation))


def option_labels(d: Domain) -> DataFrame:
    """Drop-down labels of the registration forms, one row per option.

    Columns: ``kind`` (point / lot / device / material), ``option_key``
    (the value the form submits; the composite key of a point as a JSON
    object, so no character in it is ambiguous) and ``label``. Formats are the page's: ``"{rua} — {cidade}/{estado}"``,
    ``"#{id} — {cidade}/{estado} ({data})"``,
    ``"{nome} ({categoria}, {peso} kg)"`` and ``"{nome} — {tipo}"``.
    """
    dash = " — "
    points = d.ponto_coleta.select(
        F.lit("point").alias("kind"),
        F.to_json(F.struct("rua", "cidade", "cep", "estado")).alias("option_key"),
        F.concat(F.col("rua"), F.lit(dash), F.col("cidade"), F.lit("/"), F.col("estado")).alias(
            "label"
        ),
    )
    lots = d.lote_coleta.select(
        F.lit("lot").alias("kind"),
        F.col("id_lote").cast("string").alias("option_key"),
        F.concat(
            F.lit("#"),
            F.col("id_lote").cast("string"),
            F.lit(dash),
            F.col("cidade"),
            F.lit("/"),
            F.col("estado"),
            F.lit(" ("),
            F.date_format("data_coleta", "yyyy-MM-dd"),
            F.lit(")"),
        ).alias("label"),
    )
    devices = d.dispositivo_eletronico.select(
        F.lit("device").alias("kind"),
        F.col("nome").alias("option_key"),
        F.concat(
            F.col("nome"),
            F.lit(" ("),
            F.col("categoria"),
            F.lit(", "),
            # plain notation, without the zeros of the declared scale
            F.regexp_replace(F.col("peso_medio").cast("string"), r"\.?0+$", ""),
            F.lit(" kg)"),
        ).alias("label"),
    )
    materials = d.material.select(
        F.lit("material").alias("kind"),
        F.col("nome").alias("option_key"),
        F.concat(F.col("nome"), F.lit(dash), F.col("tipo_material")).alias("label"),
    )
    return points.unionByName(lots).unionByName(devices).unionByName(materials)
