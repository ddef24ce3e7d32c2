"""Single-operator queries over the domain.

Each function isolates one relational operator the reports are built from
(join shapes, aggregate of aggregates, DISTINCT, date arithmetic), so it can
be checked on its own against another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrace.functions.scalar import transit_days
from revtrace.operators.reports import POINT_KEY, volume_by_centre
from revtrace.sources.domain import Domain


def join_inner_single_key(d: Domain) -> DataFrame:
    """Lots with their first-leg transport (one-column equi-join)."""
    tct = d.transporte_coleta_tri.select(
        F.col("cod_rastreio").alias("transporte"), "centro_triagem"
    )
    return d.lote_coleta.select("id_lote", "transporte").join(tct, "transporte").select(
        "id_lote", F.col("transporte").alias("cod_rastreio"), "centro_triagem"
    )


def join_inner_composite2(d: Domain) -> DataFrame:
    """Sorted lots with their recycling processes (two-column key)."""
    lt = d.lote_triado.select("lote_coleta", "pin_lote_tri", "categoria", "peso_exato")
    pr = d.processo_reciclagem.select(
        "lote_coleta", "pin_lote_tri", "data_processamento", "tipo_de_processamento"
    )
    return lt.join(pr, ["lote_coleta", "pin_lote_tri"])


def join_inner_composite4(d: Domain) -> DataFrame:
    """Lots with their collection point (four-column key)."""
    lc = d.lote_coleta.select("id_lote", *POINT_KEY)
    pc = d.ponto_coleta.select(*POINT_KEY, "capacidade_max")
    return lc.join(pc, POINT_KEY).select("id_lote", "cidade", "estado", "capacidade_max")


def join_left_outer(d: Domain) -> DataFrame:
    """Every lot with its sorted lots; lots never sorted keep a NULL pin.

    Written as inner join plus anti-join: adaptive execution can split a hot
    lot on either side of the inner join, but only the left side of an outer
    one, and here the right side (sorted lots) is the one that repeats keys.
    The anti-join sees each sorted lot id once.
    """
    lots = d.lote_coleta.select("id_lote")
    lt = d.lote_triado.select(F.col("lote_coleta").alias("id_lote"), "pin_lote_tri")
    never = lots.join(lt.select("id_lote").distinct(), "id_lote", "left_anti")
    pin = F.lit(None).cast(lt.schema["pin_lote_tri"].dataType).alias("pin_lote_tri")
    return lots.join(lt, "id_lote").unionByName(never.select("id_lote", pin))


def not_exists_one_level(d: Domain) -> DataFrame:
    """Lots that never produced a sorted lot, in stock or not (NOT EXISTS).

    The sorted lots are reduced to distinct lot ids before the anti-join, so
    a lot split into many sorted lots costs one row per map task.
    """
    sorted_lots = d.lote_triado.select(F.col("lote_coleta").alias("id_lote")).distinct()
    return d.lote_coleta.select("id_lote", "cidade", "estado").join(
        sorted_lots, "id_lote", "left_anti"
    )


def subtype_semi_filter(d: Domain) -> DataFrame:
    """Transports of the first leg: the subtype table used only as a filter."""
    return d.transporte.select(
        "cod_rastreio", "transportadora", "data_envio", "data_chegada"
    ).join(d.transporte_coleta_tri.select("cod_rastreio"), "cod_rastreio", "left_semi")


def sum_by_three_keys(d: Domain) -> DataFrame:
    """SUM of sorted weight grouped by (cnpj, nome, licenca_ambiental)."""
    return volume_by_centre(d)


def avg_of_group_sums(d: Domain) -> DataFrame:
    """One row: number of centres, total and mean of the per-centre sums.

    The second aggregate has no grouping key, so it is a single partial +
    final aggregate over the (already small) grouped result.
    """
    return volume_by_centre(d).agg(
        F.count("volume_total").alias("n_centres"),
        F.sum("volume_total").alias("total_volume"),
        F.round(F.avg("volume_total"), 6).alias("avg_volume"),
    )


def distinct_points(d: Domain) -> DataFrame:
    """Distinct collection-point addresses that appear on lots."""
    return d.lote_coleta.select(*POINT_KEY).distinct()


def transit_days_by_transport(d: Domain) -> DataFrame:
    """Whole days in transit for every transport (date minus date)."""
    return d.transporte.select(
        "cod_rastreio", transit_days("data_chegada", "data_envio").alias("dias")
    )
