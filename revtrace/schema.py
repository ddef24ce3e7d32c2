"""Typed relational model of the reverse-logistics domain.

Sixteen tables with their declared keys, unique constraints, foreign keys
and referential actions. This module is data plus a few pure helpers that
read it (Spark schema, topological load order, child lookup); the checks
that enforce it live in :mod:`revtrace.operators.quality`.

Column kinds follow the source DDL:

* ``varchar`` / ``char`` -> ``StringType`` with a maximum length
  (``char`` values are right-trimmed at ingest, never padded),
* ``numeric`` -> ``DecimalType(28, 6)`` (the source type is unbounded; ingest rejects
  what does not fit instead of rounding it),
* ``date`` -> ``DateType``,
* ``integer`` -> ``LongType`` (the test tables carry 64-bit keys).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

NUMERIC = T.DecimalType(28, 6)

_SPARK_TYPES = {
    "varchar": T.StringType(),
    "char": T.StringType(),
    "numeric": NUMERIC,
    "date": T.DateType(),
    "integer": T.LongType(),
}


@dataclass(frozen=True)
class Column:
    name: str
    kind: str
    length: int | None = None
    nullable: bool = False

    @property
    def spark_type(self) -> T.DataType:
        return _SPARK_TYPES[self.kind]


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    on_delete: str = "no_action"  # "no_action" | "cascade" | "set_null"


@dataclass(frozen=True)
class Unique:
    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...]
    uniques: tuple[Unique, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    pk_name: str = ""

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def column(self, name: str) -> Column:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name}.{name}")

    @property
    def spark_schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.spark_type, c.nullable) for c in self.columns]
        )


def _c(name, kind, length=None, nullable=False):
    return Column(name, kind, length, nullable)


def _fk(name, cols, parent, pcols, on_delete="no_action"):
    return ForeignKey(name, tuple(cols), parent, tuple(pcols), on_delete)


# The table catalogue transcribed from the domain DDL
# (names in lower snake case, lengths and actions as declared).
TABLES: dict[str, Table] = {
    t.name: t
    for t in [
        Table(
            "categoria",
            (_c("nome", "varchar", 50), _c("descricao", "varchar", 255, True)),
            ("nome",),
            pk_name="pk_categoria",
        ),
        Table(
            "ponto_coleta",
            (
                _c("rua", "varchar", 100),
                _c("cidade", "varchar", 50),
                _c("cep", "char", 8),
                _c("estado", "char", 2),
                _c("capacidade_max", "numeric"),
            ),
            ("rua", "cidade", "cep", "estado"),
            pk_name="pk_ponto_coleta",
        ),
        Table(
            "centro_triagem",
            (
                _c("cnpj", "char", 14),
                _c("nome", "varchar", 100),
                _c("rua", "varchar", 100),
                _c("cidade", "varchar", 50),
                _c("cep", "char", 8),
                _c("estado", "char", 2),
            ),
            ("cnpj",),
            pk_name="pk_centro_triagem",
        ),
        Table(
            "centro_reciclagem",
            (
                _c("cnpj", "char", 14),
                _c("nome", "varchar", 100),
                _c("rua", "varchar", 100),
                _c("cidade", "varchar", 50),
                _c("cep", "char", 8),
                _c("estado", "char", 2),
                _c("licenca_ambiental", "varchar", 50),
            ),
            ("cnpj",),
            (Unique("uq_licenca_ambiental", ("licenca_ambiental",)),),
            pk_name="pk_centro_reciclagem",
        ),
        Table(
            "transportadora",
            (
                _c("cnpj", "char", 14),
                _c("nome", "varchar", 100),
                _c("nro_licenca", "varchar", 50),
            ),
            ("cnpj",),
            (Unique("uq_nro_licenca", ("nro_licenca",)),),
            pk_name="pk_transportadora",
        ),
        Table(
            "material",
            (_c("nome", "varchar", 50), _c("tipo_material", "varchar", 50)),
            ("nome",),
            pk_name="pk_material",
        ),
        Table(
            "organizacao_destino",
            (_c("cnpj", "char", 14), _c("nome", "varchar", 100)),
            ("cnpj",),
            pk_name="pk_organizacao_destino",
        ),
        Table(
            "dispositivo_eletronico",
            (
                _c("nome", "varchar", 100),
                _c("peso_medio", "numeric"),
                _c("categoria", "varchar", 50),
            ),
            ("nome",),
            foreign_keys=(
                _fk("fk_disp_categoria", ["categoria"], "categoria", ["nome"]),
            ),
            pk_name="pk_dispositivo_eletronico",
        ),
        Table(
            "transporte",
            (
                _c("cod_rastreio", "varchar", 50),
                _c("transportadora", "char", 14),
                _c("data_envio", "date"),
                _c("data_chegada", "date"),
                _c("placa", "char", 7),
                _c("tipo_transporte", "varchar", 20),
            ),
            ("cod_rastreio",),
            foreign_keys=(
                _fk(
                    "fk_transp_transportadora",
                    ["transportadora"],
                    "transportadora",
                    ["cnpj"],
                ),
            ),
            pk_name="pk_transporte",
        ),
        Table(
            "transporte_coleta_tri",
            (_c("cod_rastreio", "varchar", 50), _c("centro_triagem", "char", 14)),
            ("cod_rastreio",),
            foreign_keys=(
                _fk(
                    "fk_transp_ct_transporte",
                    ["cod_rastreio"],
                    "transporte",
                    ["cod_rastreio"],
                    "cascade",
                ),
                _fk(
                    "fk_transp_ct_centro",
                    ["centro_triagem"],
                    "centro_triagem",
                    ["cnpj"],
                ),
            ),
            pk_name="pk_transporte_coleta_tri",
        ),
        Table(
            "transporte_tri_reciclagem",
            (
                _c("cod_rastreio", "varchar", 50),
                _c("centro_reciclagem", "char", 14),
                _c("mtr", "varchar", 50),
            ),
            ("cod_rastreio",),
            (Unique("uq_mtr", ("mtr",)),),
            (
                _fk(
                    "fk_transp_tr_transporte",
                    ["cod_rastreio"],
                    "transporte",
                    ["cod_rastreio"],
                    "cascade",
                ),
                _fk(
                    "fk_transp_tr_centro",
                    ["centro_reciclagem"],
                    "centro_reciclagem",
                    ["cnpj"],
                ),
            ),
            pk_name="pk_transporte_tri_reciclagem",
        ),
        Table(
            "lote_coleta",
            (
                _c("id_lote", "integer"),
                _c("rua", "varchar", 100),
                _c("cidade", "varchar", 50),
                _c("cep", "char", 8),
                _c("estado", "char", 2),
                _c("data_coleta", "date"),
                _c("transporte", "varchar", 50, True),
            ),
            ("id_lote",),
            (
                Unique(
                    "uq_chave_natural_lote",
                    ("rua", "cidade", "cep", "estado", "data_coleta"),
                ),
            ),
            (
                _fk(
                    "fk_lote_ponto_coleta",
                    ["rua", "cidade", "cep", "estado"],
                    "ponto_coleta",
                    ["rua", "cidade", "cep", "estado"],
                ),
                _fk(
                    "fk_lote_transporte",
                    ["transporte"],
                    "transporte_coleta_tri",
                    ["cod_rastreio"],
                    "set_null",
                ),
            ),
            pk_name="pk_lote_coleta",
        ),
        Table(
            "qtd_produto_lote",
            (
                _c("lote", "integer"),
                _c("dispositivo_eletronico", "varchar", 100),
                _c("quantidade", "numeric"),
            ),
            ("lote", "dispositivo_eletronico"),
            foreign_keys=(
                _fk("fk_qtd_lote", ["lote"], "lote_coleta", ["id_lote"], "cascade"),
                _fk(
                    "fk_qtd_dispositivo",
                    ["dispositivo_eletronico"],
                    "dispositivo_eletronico",
                    ["nome"],
                ),
            ),
            pk_name="pk_qtd_produto_lote",
        ),
        Table(
            "lote_triado",
            (
                _c("lote_coleta", "integer"),
                _c("pin_lote_tri", "varchar", 50),
                _c("categoria", "varchar", 50),
                _c("peso_exato", "numeric"),
                _c("data_triagem", "date"),
                _c("transporte_tri_reciclagem", "varchar", 50, True),
            ),
            ("lote_coleta", "pin_lote_tri"),
            foreign_keys=(
                _fk(
                    "fk_lote_triado_lote_coleta",
                    ["lote_coleta"],
                    "lote_coleta",
                    ["id_lote"],
                    "cascade",
                ),
                _fk(
                    "fk_lote_triado_categoria",
                    ["categoria"],
                    "categoria",
                    ["nome"],
                ),
                _fk(
                    "fk_lote_triado_transporte",
                    ["transporte_tri_reciclagem"],
                    "transporte_tri_reciclagem",
                    ["cod_rastreio"],
                    "set_null",
                ),
            ),
            pk_name="pk_lote_triado",
        ),
        Table(
            "processo_reciclagem",
            (
                _c("data_processamento", "date"),
                _c("tipo_de_processamento", "varchar", 50),
                _c("lote_coleta", "integer"),
                _c("pin_lote_tri", "varchar", 50),
            ),
            ("data_processamento", "tipo_de_processamento"),
            foreign_keys=(
                _fk(
                    "fk_processo_lote_triado",
                    ["lote_coleta", "pin_lote_tri"],
                    "lote_triado",
                    ["lote_coleta", "pin_lote_tri"],
                    "cascade",
                ),
            ),
            pk_name="pk_processo_reciclagem",
        ),
        Table(
            "material_processado",
            (
                _c("material", "varchar", 50),
                _c("data_processamento", "date"),
                _c("tipo_de_processamento", "varchar", 50),
                _c("quantidade_obtida", "numeric"),
                _c("data_despacho", "date", nullable=True),
                _c("tipo_destinacao", "varchar", 50, True),
                _c("organizacao_destino", "char", 14),
            ),
            ("material", "data_processamento", "tipo_de_processamento"),
            foreign_keys=(
                _fk(
                    "fk_mat_proc_material",
                    ["material"],
                    "material",
                    ["nome"],
                    "cascade",
                ),
                _fk(
                    "fk_mat_proc_processo",
                    ["data_processamento", "tipo_de_processamento"],
                    "processo_reciclagem",
                    ["data_processamento", "tipo_de_processamento"],
                    "cascade",
                ),
                _fk(
                    "fk_mat_proc_org_destino",
                    ["organizacao_destino"],
                    "organizacao_destino",
                    ["cnpj"],
                ),
            ),
            pk_name="pk_material_processado",
        ),
    ]
}

TABLE_NAMES: tuple[str, ...] = tuple(TABLES)


def spark_schema(table: str) -> T.StructType:
    return TABLES[table].spark_schema


def foreign_keys() -> list[tuple[str, ForeignKey]]:
    """Every (child table, foreign key) pair in catalogue order."""
    return [(t.name, fk) for t in TABLES.values() for fk in t.foreign_keys]


def children_of(parent: str) -> list[tuple[str, ForeignKey]]:
    """Foreign keys that reference ``parent`` (self references excluded)."""
    return [(c, fk) for c, fk in foreign_keys() if fk.parent == parent and c != parent]


def load_order() -> list[str]:
    """Tables in an order where every parent precedes its children.

    Derived from the FK graph (Kahn's algorithm, ties broken by catalogue
    order so the result is stable).
    """
    remaining = {
        t.name: {fk.parent for fk in t.foreign_keys if fk.parent != t.name}
        for t in TABLES.values()
    }
    order: list[str] = []
    while remaining:
        ready = [n for n in TABLES if n in remaining and not remaining[n]]
        if not ready:
            raise ValueError(f"foreign-key cycle among {sorted(remaining)}")
        for n in ready:
            order.append(n)
            del remaining[n]
        for deps in remaining.values():
            deps.difference_update(ready)
    return order


def load_levels() -> dict[str, int]:
    """Dependency level of each table (0 = no parents)."""
    level: dict[str, int] = {}
    for name in load_order():
        parents = [fk.parent for fk in TABLES[name].foreign_keys if fk.parent != name]
        level[name] = 1 + max((level[p] for p in parents), default=-1)
    return level
