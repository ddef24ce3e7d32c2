"""Domain tables derived from the supplied TPC-H-style test tables.

The test data has no reverse-logistics tables, so each domain table is a
read-only mapping of test columns into the domain schema (customers become
collection points, orders become collection lots and first-leg transports,
suppliers become recycling centres and second-leg transports, line items
become sorted lots, and so on). The mapping only supplies rows of the right
shape; every report and check runs on the resulting frames exactly as it
would on real stored tables.

All derivations are plain DataFrame expressions, so Catalyst prunes columns
and pushes filters down to the Parquet scans of the test tables.
:mod:`revtrace.plans.oracle` carries the same mapping as DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrace.schema import NUMERIC
from revtrace.sources.domain import Domain

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Fixed values of the mapping.
CRITICAL_BRANDS = ("Brand#1", "Brand#2", "Brand#3")
CRITICAL_TYPE = "Critico"
COMMON_TYPE = "Comum"
LEG1_TYPE = "Coleta-Tri"
LEG2_TYPE = "Tri-Reciclagem"
LEG2_SENT = "2001-01-01"
PROCESS_DATE = "2026-05-22"
DISPATCH_DATE = "2026-05-29"
DESTINATION_KIND = "Comercializacao"
PROCESS_MIN_WEIGHT = 45


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _str(c: Column) -> Column:
    return c.cast("string")


def domain_from_testdata(
    spark: SparkSession,
    sf_dir: str,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Domain:
    """Lazily derived domain over ``{sf_dir}/*.parquet``.

    ``keep`` gets the line-item groups that three tables are derived from; a
    job that reads all three can write them once.
    """

    @cache
    def t(name: str) -> DataFrame:
        return read_test_table(spark, sf_dir, name)

    @cache
    def customer_points() -> DataFrame:
        # one collection point per customer, keyed by custkey for lot lookup
        return t("customer").join(
            t("nation"), F.col("c_nationkey") == F.col("n_nationkey")
        ).select(
            F.col("c_custkey"),
            F.col("c_name").alias("rua"),
            F.col("n_name").alias("cidade"),
            _pad(F.col("c_custkey"), 8).alias("cep"),
            F.concat(F.lit("R"), _str(F.col("n_regionkey"))).alias("estado"),
            F.col("c_acctbal").cast(NUMERIC).alias("capacidade_max"),
        )

    def carrier_of_priority(c: Column) -> Column:
        return _pad(F.substring(c, 1, 1), 14)

    @cache
    def shipped_orders() -> DataFrame:
        return t("orders").filter(F.col("o_orderstatus") != "P")

    def max_equals(c: str, value: str) -> Column:
        # max(c) = value, written with boolean aggregates: their buffers are
        # fixed-width, so the grouping stays a hash aggregate (a string max
        # would force a sort-based aggregate over all line items)
        col = F.col(c)
        return F.bool_and(col <= F.lit(value)) & F.bool_or(col == F.lit(value))

    @cache
    def sorted_groups() -> DataFrame:
        # one sorted lot per (order, line, part, supplier) group of line items
        groups = t("lineitem").groupBy(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
        ).agg(
            F.sum(F.col("l_quantity").cast(NUMERIC)).alias("peso"),
            F.max("l_shipdate").alias("ship"),
            max_equals("l_linestatus", "F").alias("all_final"),
            max_equals("l_returnflag", "R").alias("returned"),
        )
        return keep(groups).withColumn(
            "pin",
            F.concat_ws(
                "-",
                _str(F.col("l_linenumber")),
                _str(F.col("l_partkey")),
                _str(F.col("l_suppkey")),
            ),
        )

    @cache
    def processed_groups() -> DataFrame:
        return sorted_groups().filter(
            F.col("returned") & (F.col("peso") >= PROCESS_MIN_WEIGHT)
        ).withColumn(
            "tipo",
            F.concat(F.lit("P-"), _str(F.col("l_orderkey")), F.lit("-"), F.col("pin")),
        )

    def categoria() -> DataFrame:
        return (
            t("part")
            .select(F.col("p_type").alias("nome"))
            .distinct()
            .withColumn("descricao", F.lit(None).cast("string"))
        )

    def material() -> DataFrame:
        return (
            t("part")
            .select(F.col("p_brand").alias("nome"))
            .distinct()
            .withColumn(
                "tipo_material",
                F.when(F.col("nome").isin(*CRITICAL_BRANDS), F.lit(CRITICAL_TYPE))
                .otherwise(F.lit(COMMON_TYPE)),
            )
        )

    def organizacao_destino() -> DataFrame:
        return t("region").select(
            _pad(F.col("r_regionkey"), 14).alias("cnpj"),
            F.col("r_name").alias("nome"),
        )

    def ponto_coleta() -> DataFrame:
        return customer_points().drop("c_custkey")

    def centro_triagem() -> DataFrame:
        return t("nation").select(
            _pad(F.col("n_nationkey"), 14).alias("cnpj"),
            F.col("n_name").alias("nome"),
            F.concat(F.lit("Rua "), F.col("n_name")).alias("rua"),
            F.col("n_name").alias("cidade"),
            _pad(F.col("n_nationkey"), 8).alias("cep"),
            F.concat(F.lit("R"), _str(F.col("n_regionkey"))).alias("estado"),
        )

    def centro_reciclagem() -> DataFrame:
        return t("supplier").join(
            t("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select(
            _pad(F.col("s_suppkey"), 14).alias("cnpj"),
            F.col("s_name").alias("nome"),
            F.concat(F.lit("Rua "), F.col("s_name")).alias("rua"),
            F.col("n_name").alias("cidade"),
            _pad(F.col("s_suppkey"), 8).alias("cep"),
            F.concat(F.lit("R"), _str(F.col("n_regionkey"))).alias("estado"),
            F.concat(F.lit("LIC-"), _str(F.col("s_suppkey"))).alias("licenca_ambiental"),
        )

    def transportadora() -> DataFrame:
        return (
            t("orders")
            .select(
                carrier_of_priority(F.col("o_orderpriority")).alias("cnpj"),
                F.col("o_orderpriority").alias("nome"),
                F.concat(F.lit("ANTT-"), F.substring("o_orderpriority", 1, 1)).alias(
                    "nro_licenca"
                ),
            )
            .distinct()
        )

    def transporte() -> DataFrame:
        sent1 = F.to_date(F.col("o_orderdate"))
        leg1 = shipped_orders().select(
            F.concat(F.lit("CT-"), _str(F.col("o_orderkey"))).alias("cod_rastreio"),
            carrier_of_priority(F.col("o_orderpriority")).alias("transportadora"),
            sent1.alias("data_envio"),
            F.date_add(sent1, (F.col("o_orderkey") % 11).cast("int")).alias(
                "data_chegada"
            ),
            _pad(F.col("o_orderkey") % 10000000, 7).alias("placa"),
            F.lit(LEG1_TYPE).alias("tipo_transporte"),
        )
        sent2 = F.lit(LEG2_SENT).cast("date")
        leg2 = t("supplier").select(
            F.concat(F.lit("TR-"), _str(F.col("s_suppkey"))).alias("cod_rastreio"),
            _pad(F.col("s_suppkey") % 5 + 1, 14).alias("transportadora"),
            sent2.alias("data_envio"),
            F.date_add(sent2, (F.col("s_suppkey") % 30).cast("int")).alias(
                "data_chegada"
            ),
            _pad(F.col("s_suppkey") % 10000000, 7).alias("placa"),
            F.lit(LEG2_TYPE).alias("tipo_transporte"),
        )
        return leg1.unionByName(leg2)

    def transporte_coleta_tri() -> DataFrame:
        return shipped_orders().join(
            t("customer"), F.col("o_custkey") == F.col("c_custkey")
        ).select(
            F.concat(F.lit("CT-"), _str(F.col("o_orderkey"))).alias("cod_rastreio"),
            _pad(F.col("c_nationkey"), 14).alias("centro_triagem"),
        )

    def transporte_tri_reciclagem() -> DataFrame:
        return t("supplier").select(
            F.concat(F.lit("TR-"), _str(F.col("s_suppkey"))).alias("cod_rastreio"),
            _pad(F.col("s_suppkey"), 14).alias("centro_reciclagem"),
            F.concat(F.lit("MTR-"), _str(F.col("s_suppkey"))).alias("mtr"),
        )

    def lote_coleta() -> DataFrame:
        return t("orders").join(
            customer_points(), F.col("o_custkey") == F.col("c_custkey")
        ).select(
            F.col("o_orderkey").alias("id_lote"),
            "rua",
            "cidade",
            "cep",
            "estado",
            F.to_date(F.col("o_orderdate")).alias("data_coleta"),
            F.when(
                F.col("o_orderstatus") != "P",
                F.concat(F.lit("CT-"), _str(F.col("o_orderkey"))),
            ).alias("transporte"),
        )

    def qtd_produto_lote() -> DataFrame:
        per_part = t("lineitem").groupBy("l_orderkey", "l_partkey").agg(
            F.sum(F.col("l_quantity").cast(NUMERIC)).alias("quantidade")
        )
        return per_part.join(t("part"), F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_orderkey").alias("lote"),
            F.concat(F.col("p_name"), F.lit(" #"), _str(F.col("p_partkey"))).alias(
                "dispositivo_eletronico"
            ),
            F.col("quantidade"),
        )

    def lote_triado() -> DataFrame:
        return sorted_groups().join(
            t("part"), F.col("l_partkey") == F.col("p_partkey")
        ).select(
            F.col("l_orderkey").alias("lote_coleta"),
            F.col("pin").alias("pin_lote_tri"),
            F.col("p_type").alias("categoria"),
            F.col("peso").alias("peso_exato"),
            F.to_date(F.col("ship")).alias("data_triagem"),
            F.when(
                F.col("all_final"),
                F.concat(F.lit("TR-"), _str(F.col("l_suppkey"))),
            ).alias("transporte_tri_reciclagem"),
        )

    def processo_reciclagem() -> DataFrame:
        return processed_groups().select(
            F.lit(PROCESS_DATE).cast("date").alias("data_processamento"),
            F.col("tipo").alias("tipo_de_processamento"),
            F.col("l_orderkey").alias("lote_coleta"),
            F.col("pin").alias("pin_lote_tri"),
        )

    def material_processado() -> DataFrame:
        supplier_region = t("supplier").join(
            t("nation"), F.col("s_nationkey") == F.col("n_nationkey")
        ).select("s_suppkey", "n_regionkey")
        return (
            processed_groups()
            .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(supplier_region, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                F.col("p_brand").alias("material"),
                F.lit(PROCESS_DATE).cast("date").alias("data_processamento"),
                F.col("tipo").alias("tipo_de_processamento"),
                F.col("peso").alias("quantidade_obtida"),
                F.lit(DISPATCH_DATE).cast("date").alias("data_despacho"),
                F.lit(DESTINATION_KIND).alias("tipo_destinacao"),
                _pad(F.col("n_regionkey"), 14).alias("organizacao_destino"),
            )
        )

    builders = {
        "categoria": categoria,
        "ponto_coleta": ponto_coleta,
        "centro_triagem": centro_triagem,
        "centro_reciclagem": centro_reciclagem,
        "transportadora": transportadora,
        "material": material,
        "organizacao_destino": organizacao_destino,
        "dispositivo_eletronico": lambda: t("part").select(
            F.concat(F.col("p_name"), F.lit(" #"), _str(F.col("p_partkey"))).alias(
                "nome"
            ),
            F.col("p_size").cast(NUMERIC).alias("peso_medio"),
            F.col("p_type").alias("categoria"),
        ),
        "transporte": transporte,
        "transporte_coleta_tri": transporte_coleta_tri,
        "transporte_tri_reciclagem": transporte_tri_reciclagem,
        "lote_coleta": lote_coleta,
        "qtd_produto_lote": qtd_produto_lote,
        "lote_triado": lote_triado,
        "processo_reciclagem": processo_reciclagem,
        "material_processado": material_processado,
    }
    return Domain(spark, builders)
