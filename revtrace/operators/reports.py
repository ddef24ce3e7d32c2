"""The five analytical reports.

Each report takes a :class:`~revtrace.sources.domain.Domain` and returns a
lazy DataFrame whose columns and order match the source report. Numeric
results stay exact (decimal) here; callers that compare against another
engine cast them.

Shape of the plans, written for tables far larger than memory:

* every join is an equi-join on declared keys; no cross joins, no
  all-pairs expansion,
* existence tests are ``left_semi`` / ``left_anti`` joins; where the
  right side can repeat a key (sorted lots per lot, lots per point) it is
  reduced to distinct keys first, so a key that holds a large share of the
  rows is collapsed by the map-side partial aggregate before the shuffle,
* sums are pre-aggregated on the join key before joining (exact for SUM),
* the small sides are not hinted: adaptive execution broadcasts a side only
  after measuring it below ``spark.sql.adaptive.autoBroadcastJoinThreshold``
  and keeps a shuffled join otherwise; skewed partitions of shuffled joins
  are split by the skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrace.functions.scalar import round_ratio_half_away, transit_days
from revtrace.sources.domain import Domain

# Fixed value: material type that the division report requires in full.
CRITICAL_TYPE = "Critico"

POINT_KEY = ["rua", "cidade", "cep", "estado"]
PROCESS_KEY = ["data_processamento", "tipo_de_processamento"]


def _asc(c: str):
    return F.col(c).asc_nulls_last()


def _desc(c: str):
    return F.col(c).desc_nulls_first()


def critical_centre_materials(d: Domain, required: DataFrame) -> DataFrame:
    """Distinct (cnpj, material) pairs: a centre processed a required material.

    Path: material output -> process on (date, type) -> sorted lot on
    (lot, pin) -> second-leg transport -> recycling centre.
    """
    mp = d.material_processado.select("material", *PROCESS_KEY).join(
        required, "material", "left_semi"
    )
    pr = d.processo_reciclagem.select(*PROCESS_KEY, "lote_coleta", "pin_lote_tri")
    lt = d.lote_triado.select(
        "lote_coleta", "pin_lote_tri", "transporte_tri_reciclagem"
    )
    ttr = d.transporte_tri_reciclagem.select(
        F.col("cod_rastreio").alias("transporte_tri_reciclagem"),
        F.col("centro_reciclagem").alias("cnpj"),
    )
    return (
        mp.join(pr, PROCESS_KEY)
        .join(lt, ["lote_coleta", "pin_lote_tri"])
        .join(ttr, "transporte_tri_reciclagem")
        .select("cnpj", "material")
        .distinct()
    )


def relational_division(d: Domain, material_type: str = CRITICAL_TYPE) -> DataFrame:
    """Recycling centres that processed every material of ``material_type``.

    Counting form of relational division: a centre qualifies when the number
    of distinct required materials it processed equals the number of
    required materials. A centre with no processed material has count 0, so
    with an empty required set every centre qualifies (vacuous truth), as in
    the double NOT EXISTS form. The required-set size is a one-row scalar
    subquery, never a cross join.
    """
    required = (
        d.material.filter(F.col("tipo_material") == F.lit(material_type))
        .select(F.col("nome").alias("material"))
        .distinct()
    )
    n_required = required.agg(F.count(F.lit(1))).scalar()
    have = (
        critical_centre_materials(d, required)
        .groupBy("cnpj")
        .agg(F.count(F.lit(1)).alias("n_have"))
    )
    centres = d.centro_reciclagem.select("cnpj", "nome", "cidade", "estado")
    return (
        centres.join(have, "cnpj", "left")
        .filter(F.coalesce(F.col("n_have"), F.lit(0)) == n_required)
        .select("cnpj", "nome", "cidade", "estado")
        .orderBy(_asc("nome"), _asc("cnpj"))
    )


def lots_without_sorting(d: Domain) -> DataFrame:
    """Lots that reached a sorting centre but have no sorted lot.

    The anti-join runs first so that only the unsorted lots meet the
    transport tables; lots with no transport drop out at the inner join.
    """
    sorted_lots = d.lote_triado.select(F.col("lote_coleta").alias("id_lote")).distinct()
    lots = (
        d.lote_coleta.select(
            "id_lote",
            "data_coleta",
            F.col("cidade").alias("cidade_origem"),
            F.col("transporte").alias("cod_rastreio"),
        )
        .join(sorted_lots, "id_lote", "left_anti")
    )
    tct = d.transporte_coleta_tri.select(
        "cod_rastreio", F.col("centro_triagem").alias("ct_cnpj")
    )
    t = d.transporte.select(
        "cod_rastreio", F.col("data_chegada").alias("chegada_ao_centro")
    )
    ct = d.centro_triagem.select(
        F.col("cnpj").alias("ct_cnpj"), F.col("nome").alias("centro_triagem")
    )
    return (
        lots.join(tct, "cod_rastreio")
        .join(t, "cod_rastreio")
        .join(ct, "ct_cnpj")
        .select(
            "id_lote",
            "data_coleta",
            "cidade_origem",
            "centro_triagem",
            "chegada_ao_centro",
        )
        .orderBy(_asc("chegada_ao_centro"), _asc("id_lote"))
    )


def volume_by_centre(d: Domain) -> DataFrame:
    """SUM of dispatched sorted weight per licensed recycling centre.

    Sorted lots are summed per transport first (one row per transport
    leaves the map side), then joined to the transport and centre.
    """
    per_transport = (
        d.lote_triado.filter(F.col("transporte_tri_reciclagem").isNotNull())
        .groupBy(F.col("transporte_tri_reciclagem").alias("cod_rastreio"))
        .agg(F.sum("peso_exato").alias("peso"))
    )
    ttr = d.transporte_tri_reciclagem.select(
        "cod_rastreio", F.col("centro_reciclagem").alias("cnpj")
    )
    centres = d.centro_reciclagem.filter(
        F.col("licenca_ambiental").isNotNull()
    ).select("cnpj", "nome", "licenca_ambiental")
    return (
        per_transport.join(ttr, "cod_rastreio")
        .join(centres, "cnpj")
        .groupBy("cnpj", "nome", "licenca_ambiental")
        .agg(F.sum("peso").alias("volume_total"))
    )


def centres_above_average(d: Domain) -> DataFrame:
    """Centres whose volume is strictly above the mean volume of all centres.

    ``volume > avg`` is evaluated as ``volume * n > total`` in exact
    decimals (a rounded mean could turn a volume just above it into a tie).
    ``total`` and ``n`` come from one single-row aggregate used as a scalar
    subquery; with no centres the mean is NULL and nothing is returned.
    """
    vol = volume_by_centre(d)
    stats = vol.agg(
        F.struct(
            F.sum("volume_total").alias("total"),
            F.count("volume_total").alias("n"),
        ).alias("s")
    ).scalar()
    return (
        vol.filter(
            F.col("volume_total") * stats.getField("n").cast("decimal(20,0)")
            > stats.getField("total")
        )
        .select("cnpj", "nome", "licenca_ambiental", "volume_total")
        .orderBy(_desc("volume_total"), _asc("cnpj"))
    )


def trace_origin_by_material(d: Domain, material: str) -> DataFrame:
    """Distinct collection points whose lots yielded ``material``.

    The parameter is a literal pushed to the material scan. Lots are reached
    from the process rows directly (the process carries the lot id), and the
    result keeps the points that exist in the point table. White space around
    the parameter is dropped and a blank one is refused (``ValueError``).
    Case-sensitive; an unknown material gives no rows.
    """
    material = (material or "").strip()
    if not material:
        raise ValueError("a material name is required")
    mp = d.material_processado.filter(F.col("material") == F.lit(material)).select(
        *PROCESS_KEY
    )
    lots = (
        d.processo_reciclagem.join(mp, PROCESS_KEY, "left_semi")
        .select(F.col("lote_coleta").alias("id_lote"))
        .distinct()
    )
    hit_points = (
        d.lote_coleta.join(lots, "id_lote", "left_semi").select(*POINT_KEY).distinct()
    )
    points = d.ponto_coleta.select(*POINT_KEY)
    return hit_points.join(points, POINT_KEY, "left_semi").orderBy(
        _asc("cidade"), _asc("rua"), _asc("cep"), _asc("estado")
    )


def carrier_mean_transit(d: Domain) -> DataFrame:
    """Mean first-leg transit days per carrier, rounded to 2 decimals.

    Transports are restricted to the first leg with a semi-join on the
    subtype table, summed per carrier on the map side (a carrier may own a
    large share of all trips), then joined to the carrier. The mean is
    ``sum / count`` rounded half away from zero in exact integer arithmetic.
    """
    leg1 = d.transporte.select(
        "cod_rastreio",
        "transportadora",
        transit_days("data_chegada", "data_envio").alias("dias"),
    ).join(d.transporte_coleta_tri.select("cod_rastreio"), "cod_rastreio", "left_semi")
    per_carrier = leg1.groupBy(F.col("transportadora").alias("cnpj")).agg(
        F.sum("dias").alias("s"), F.count("dias").alias("n")
    )
    carriers = d.transportadora.select("cnpj", "nome")
    return (
        carriers.join(per_carrier, "cnpj")
        .groupBy("cnpj", "nome")
        .agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        .select(
            "cnpj",
            "nome",
            round_ratio_half_away(F.col("s"), F.col("n"), 2).alias("media_dias"),
        )
        .orderBy(_asc("media_dias"), _asc("cnpj"))
    )
