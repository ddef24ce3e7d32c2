"""Deterministic constraint violations injected into a clean domain.

The mapped test tables satisfy every declared key, so the checks would
only ever report zeros. This module plants faults selected by a modulus on
each row's own key (input building only; the checks know nothing about it):

* ``ponto_coleta``: capacity NULL every 17th customer; every 23rd point
  appended a second time (primary key duplicates),
* ``lote_coleta``: every 19th lot gets 60 extra characters in ``cidade``
  (too long, and no longer matches its point: foreign key orphan),
* ``lote_triado``: category NULL every 17th lot; second-leg transport
  pointing at a missing code every 29th lot; every 23rd lot's rows
  appended again (primary key duplicates),
* ``qtd_produto_lote``: device name pointing at a missing device every
  29th lot.

:data:`FAULTY_VIEWS_SQL` is the same injection for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from revtrace.sources.domain import Domain

# Fixed values of the injection.
NULL_EVERY = 17
LONG_EVERY = 19
DUP_EVERY = 23
ORPHAN_EVERY = 29
LONG_SUFFIX = "X" * 60
MISSING_TRANSPORT = "TR-missing"
MISSING_DEVICE_PREFIX = "missing-"


def with_faults(d: Domain) -> Domain:
    pc = d.ponto_coleta
    cust = F.col("cep").cast("long")
    pc_f = pc.withColumn(
        "capacidade_max",
        F.when(cust % NULL_EVERY == 0, F.lit(None)).otherwise(F.col("capacidade_max")),
    ).unionByName(pc.filter(cust % DUP_EVERY == 0))

    lc = d.lote_coleta
    lc_f = lc.withColumn(
        "cidade",
        F.when(
            F.col("id_lote") % LONG_EVERY == 0,
            F.concat(F.col("cidade"), F.lit(LONG_SUFFIX)),
        ).otherwise(F.col("cidade")),
    )

    lt = d.lote_triado
    lot = F.col("lote_coleta")
    lt_f = (
        lt.withColumn(
            "categoria",
            F.when(lot % NULL_EVERY == 0, F.lit(None)).otherwise(F.col("categoria")),
        )
        .withColumn(
            "transporte_tri_reciclagem",
            F.when(
                (lot % ORPHAN_EVERY == 0) & F.col("transporte_tri_reciclagem").isNotNull(),
                F.lit(MISSING_TRANSPORT),
            ).otherwise(F.col("transporte_tri_reciclagem")),
        )
        .unionByName(lt.filter(lot % DUP_EVERY == 0))
    )

    q = d.qtd_produto_lote
    q_f = q.withColumn(
        "dispositivo_eletronico",
        F.when(
            F.col("lote") % ORPHAN_EVERY == 0,
            F.concat(F.lit(MISSING_DEVICE_PREFIX), F.col("dispositivo_eletronico")),
        ).otherwise(F.col("dispositivo_eletronico")),
    )
    return d.replace(
        ponto_coleta=pc_f, lote_coleta=lc_f, lote_triado=lt_f, qtd_produto_lote=q_f
    )


FAULTY_TABLES = ("ponto_coleta", "lote_coleta", "lote_triado", "qtd_produto_lote")

FAULTY_VIEWS_SQL = f"""
ponto_coleta_f AS (
  SELECT rua, cidade, cep, estado,
         CASE WHEN CAST(cep AS BIGINT) % {NULL_EVERY} = 0 THEN NULL
              ELSE capacidade_max END AS capacidade_max
  FROM ponto_coleta
  UNION ALL
  SELECT * FROM ponto_coleta WHERE CAST(cep AS BIGINT) % {DUP_EVERY} = 0),
lote_coleta_f AS (
  SELECT id_lote, rua,
         CASE WHEN id_lote % {LONG_EVERY} = 0 THEN cidade || '{LONG_SUFFIX}'
              ELSE cidade END AS cidade,
         cep, estado, data_coleta, transporte
  FROM lote_coleta),
lote_triado_f AS (
  SELECT lote_coleta, pin_lote_tri,
         CASE WHEN lote_coleta % {NULL_EVERY} = 0 THEN NULL ELSE categoria END AS categoria,
         peso_exato, data_triagem,
         CASE WHEN lote_coleta % {ORPHAN_EVERY} = 0 AND transporte_tri_reciclagem IS NOT NULL
              THEN '{MISSING_TRANSPORT}' ELSE transporte_tri_reciclagem END
           AS transporte_tri_reciclagem
  FROM lote_triado
  UNION ALL
  SELECT * FROM lote_triado WHERE lote_coleta % {DUP_EVERY} = 0),
qtd_produto_lote_f AS (
  SELECT lote,
         CASE WHEN lote % {ORPHAN_EVERY} = 0
              THEN '{MISSING_DEVICE_PREFIX}' || dispositivo_eletronico
              ELSE dispositivo_eletronico END AS dispositivo_eletronico,
         quantidade
  FROM qtd_produto_lote)
"""
