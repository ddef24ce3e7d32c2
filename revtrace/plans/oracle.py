"""Independent DuckDB SQL for every registered query.

Only the raw test tables are registered in the checker, so each statement
starts with the domain mapping of :mod:`revtrace.sources.testdata` written
as CTEs (``DOMAIN_VIEWS``). The reports are stated from their meaning, in
other forms than the Spark plans: division and "never sorted" as set
differences, the mean comparison with window totals, lineage with nested IN,
the mean transit as sum over count.

Decimal results are cast to DOUBLE here and in the Spark registry, since the
two engines widen sums differently; dates are compared as ISO text.
"""

from __future__ import annotations

DOMAIN_VIEWS = """
cust_point AS (
  SELECT c_custkey, c_name AS rua, n_name AS cidade,
         lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS cep,
         'R' || CAST(n_regionkey AS VARCHAR) AS estado,
         CAST(c_acctbal AS DECIMAL(18,2)) AS capacidade_max
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
categoria AS (
  SELECT DISTINCT p_type AS nome, CAST(NULL AS VARCHAR) AS descricao FROM part),
material AS (
  SELECT DISTINCT p_brand AS nome,
         CASE WHEN p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')
              THEN 'Critico' ELSE 'Comum' END AS tipo_material
  FROM part),
organizacao_destino AS (
  SELECT lpad(CAST(r_regionkey AS VARCHAR), 14, '0') AS cnpj, r_name AS nome
  FROM region),
ponto_coleta AS (
  SELECT rua, cidade, cep, estado, capacidade_max FROM cust_point),
centro_triagem AS (
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 14, '0') AS cnpj, n_name AS nome,
         'Rua ' || n_name AS rua, n_name AS cidade,
         lpad(CAST(n_nationkey AS VARCHAR), 8, '0') AS cep,
         'R' || CAST(n_regionkey AS VARCHAR) AS estado
  FROM nation),
centro_reciclagem AS (
  SELECT lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS cnpj, s_name AS nome,
         'Rua ' || s_name AS rua, n_name AS cidade,
         lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS cep,
         'R' || CAST(n_regionkey AS VARCHAR) AS estado,
         'LIC-' || CAST(s_suppkey AS VARCHAR) AS licenca_ambiental
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
transportadora AS (
  SELECT DISTINCT lpad(substr(o_orderpriority, 1, 1), 14, '0') AS cnpj,
         o_orderpriority AS nome,
         'ANTT-' || substr(o_orderpriority, 1, 1) AS nro_licenca
  FROM orders),
dispositivo_eletronico AS (
  SELECT p_name || ' #' || CAST(p_partkey AS VARCHAR) AS nome,
         CAST(p_size AS DECIMAL(18,2)) AS peso_medio, p_type AS categoria
  FROM part),
transporte AS (
  SELECT 'CT-' || CAST(o_orderkey AS VARCHAR) AS cod_rastreio,
         lpad(substr(o_orderpriority, 1, 1), 14, '0') AS transportadora,
         CAST(o_orderdate AS DATE) AS data_envio,
         CAST(o_orderdate AS DATE) + CAST(o_orderkey % 11 AS INTEGER) AS data_chegada,
         lpad(CAST(o_orderkey % 10000000 AS VARCHAR), 7, '0') AS placa,
         'Coleta-Tri' AS tipo_transporte
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT 'TR-' || CAST(s_suppkey AS VARCHAR),
         lpad(CAST(s_suppkey % 5 + 1 AS VARCHAR), 14, '0'),
         DATE '2001-01-01',
         DATE '2001-01-01' + CAST(s_suppkey % 30 AS INTEGER),
         lpad(CAST(s_suppkey % 10000000 AS VARCHAR), 7, '0'),
         'Tri-Reciclagem'
  FROM supplier),
transporte_coleta_tri AS (
  SELECT 'CT-' || CAST(o_orderkey AS VARCHAR) AS cod_rastreio,
         lpad(CAST(c_nationkey AS VARCHAR), 14, '0') AS centro_triagem
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderstatus <> 'P'),
transporte_tri_reciclagem AS (
  SELECT 'TR-' || CAST(s_suppkey AS VARCHAR) AS cod_rastreio,
         lpad(CAST(s_suppkey AS VARCHAR), 14, '0') AS centro_reciclagem,
         'MTR-' || CAST(s_suppkey AS VARCHAR) AS mtr
  FROM supplier),
lote_coleta AS (
  SELECT o_orderkey AS id_lote, p.rua, p.cidade, p.cep, p.estado,
         CAST(o_orderdate AS DATE) AS data_coleta,
         CASE WHEN o_orderstatus <> 'P'
              THEN 'CT-' || CAST(o_orderkey AS VARCHAR) END AS transporte
  FROM orders JOIN cust_point p ON o_custkey = p.c_custkey),
qtd_produto_lote AS (
  SELECT g.l_orderkey AS lote,
         p_name || ' #' || CAST(p_partkey AS VARCHAR) AS dispositivo_eletronico,
         g.quantidade
  FROM (SELECT l_orderkey, l_partkey,
               SUM(CAST(l_quantity AS DECIMAL(18,2))) AS quantidade
        FROM lineitem GROUP BY l_orderkey, l_partkey) g
  JOIN part ON g.l_partkey = p_partkey),
sorted_groups AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         SUM(CAST(l_quantity AS DECIMAL(18,2))) AS peso,
         MAX(l_shipdate) AS ship, MAX(l_linestatus) AS linestatus,
         MAX(l_returnflag) AS returnflag,
         CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey AS VARCHAR)
           || '-' || CAST(l_suppkey AS VARCHAR) AS pin
  FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey),
lote_triado AS (
  SELECT g.l_orderkey AS lote_coleta, g.pin AS pin_lote_tri, p_type AS categoria,
         g.peso AS peso_exato, CAST(g.ship AS DATE) AS data_triagem,
         CASE WHEN g.linestatus = 'F'
              THEN 'TR-' || CAST(g.l_suppkey AS VARCHAR) END AS transporte_tri_reciclagem
  FROM sorted_groups g JOIN part ON g.l_partkey = p_partkey),
processed_groups AS (
  SELECT *, 'P-' || CAST(l_orderkey AS VARCHAR) || '-' || pin AS tipo
  FROM sorted_groups WHERE returnflag = 'R' AND peso >= 45),
processo_reciclagem AS (
  SELECT DATE '2026-05-22' AS data_processamento, tipo AS tipo_de_processamento,
         l_orderkey AS lote_coleta, pin AS pin_lote_tri
  FROM processed_groups),
material_processado AS (
  SELECT p_brand AS material, DATE '2026-05-22' AS data_processamento,
         g.tipo AS tipo_de_processamento, g.peso AS quantidade_obtida,
         DATE '2026-05-29' AS data_despacho, 'Comercializacao' AS tipo_destinacao,
         lpad(CAST(n_regionkey AS VARCHAR), 14, '0') AS organizacao_destino
  FROM processed_groups g
  JOIN part ON g.l_partkey = p_partkey
  JOIN supplier ON g.l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)
"""


REPORT_KEYS = (
    "relational_division",
    "lots_without_sorting",
    "centres_above_average",
    "trace_origin_by_material",
    "carrier_mean_transit",
)


def with_domain(body: str, extra_ctes: str = "") -> str:
    ctes = DOMAIN_VIEWS.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    body = body.strip()
    if body.startswith("WITH"):
        body = f"SELECT * FROM ({body}) body"
    return f"WITH {'RECURSIVE ' if 'walk_lots' in ctes else ''}{ctes}\n{body}"


REPORTS: dict[str, str] = {
    # Recycling centres minus those that lack some critical material.
    "relational_division": """
SELECT cnpj, nome, cidade, estado
FROM centro_reciclagem
WHERE cnpj NOT IN (
  SELECT missing.cnpj FROM (
    SELECT c.cnpj, m.nome AS material
    FROM centro_reciclagem c, (SELECT nome FROM material WHERE tipo_material = 'Critico') m
    EXCEPT
    SELECT leg.centro_reciclagem, done.material
    FROM material_processado done, processo_reciclagem step, lote_triado batch,
         transporte_tri_reciclagem leg
    WHERE (done.data_processamento, done.tipo_de_processamento)
          = (step.data_processamento, step.tipo_de_processamento)
      AND (step.lote_coleta, step.pin_lote_tri) = (batch.lote_coleta, batch.pin_lote_tri)
      AND batch.transporte_tri_reciclagem = leg.cod_rastreio) missing)
""",
    # Lot ids minus sorted lot ids, then what is known of their first leg.
    "lots_without_sorting": """
WITH pending AS (SELECT id_lote FROM lote_coleta EXCEPT SELECT lote_coleta FROM lote_triado),
first_leg AS (
  SELECT cod_rastreio, nome AS centro_triagem, data_chegada AS chegada_ao_centro
  FROM (SELECT cod_rastreio, centro_triagem AS cnpj FROM transporte_coleta_tri)
  JOIN centro_triagem USING (cnpj)
  JOIN (SELECT cod_rastreio, data_chegada FROM transporte) USING (cod_rastreio))
SELECT id_lote, data_coleta, cidade AS cidade_origem, centro_triagem, chegada_ao_centro
FROM pending JOIN lote_coleta USING (id_lote) JOIN first_leg ON first_leg.cod_rastreio = transporte
""",
    # A volume is above the mean if it times the number of centres exceeds the sum.
    "centres_above_average": """
SELECT cnpj, nome, licenca_ambiental, CAST(volume_total AS DOUBLE) AS volume_total
FROM (SELECT *, COUNT(volume_total) OVER () AS centres, SUM(volume_total) OVER () AS everything
      FROM volume_por_centro) totals
WHERE volume_total * centres > everything
""",
    "trace_origin_by_material": """
SELECT rua, cidade, cep, estado FROM ponto_coleta
WHERE (rua, cidade, cep, estado) IN (
  SELECT (rua, cidade, cep, estado) FROM lote_coleta WHERE id_lote IN (
    SELECT lote_coleta FROM processo_reciclagem
    WHERE (data_processamento, tipo_de_processamento) IN (
      SELECT (data_processamento, tipo_de_processamento) FROM material_processado
      WHERE material = 'Brand#1')))
""",
    "carrier_mean_transit": """
WITH legs AS (
  SELECT transportadora AS cnpj, SUM(datediff('day', data_envio, data_chegada)) AS days,
         COUNT(data_chegada - data_envio) AS trips
  FROM transporte WHERE cod_rastreio IN (SELECT cod_rastreio FROM transporte_coleta_tri)
  GROUP BY transportadora)
SELECT cnpj, nome, CAST(ROUND(days / trips, 2) AS DOUBLE) AS media_dias
FROM legs JOIN transportadora USING (cnpj)
""",
}

LISTINGS: dict[str, str] = {
    "list_collection_points": "SELECT rua, cidade, cep, estado FROM ponto_coleta ORDER BY cidade, rua",
    "list_devices": "SELECT nome, CAST(peso_medio AS DOUBLE) AS peso_medio, categoria FROM dispositivo_eletronico ORDER BY nome",
    "list_lots": "SELECT id_lote, data_coleta, cidade, estado FROM lote_coleta ORDER BY id_lote",
    "list_materials": "SELECT nome, tipo_material FROM material ORDER BY nome",
    "list_sorting_centres": "SELECT cnpj, nome, cidade FROM centro_triagem ORDER BY nome",
    "list_recycling_centres": "SELECT cnpj, nome, cidade, licenca_ambiental FROM centro_reciclagem ORDER BY nome",
    "list_carriers": "SELECT cnpj, nome FROM transportadora ORDER BY nome",
}

OPERATORS: dict[str, str] = {
    "join_inner_single_key": """
SELECT lc.id_lote, tct.cod_rastreio, tct.centro_triagem
FROM lote_coleta lc JOIN transporte_coleta_tri tct ON lc.transporte = tct.cod_rastreio
""",
    "join_inner_composite2": """
SELECT lt.lote_coleta, lt.pin_lote_tri, lt.categoria,
       CAST(lt.peso_exato AS DOUBLE) AS peso_exato,
       pr.data_processamento, pr.tipo_de_processamento
FROM lote_triado lt
JOIN processo_reciclagem pr ON lt.lote_coleta = pr.lote_coleta
                           AND lt.pin_lote_tri = pr.pin_lote_tri
""",
    "join_inner_composite4": """
SELECT lc.id_lote, lc.cidade, lc.estado, CAST(pc.capacidade_max AS DOUBLE) AS capacidade_max
FROM lote_coleta lc
JOIN ponto_coleta pc ON pc.rua = lc.rua AND pc.cidade = lc.cidade
                    AND pc.cep = lc.cep AND pc.estado = lc.estado
""",
    "join_left_outer": """
SELECT lc.id_lote, lt.pin_lote_tri
FROM lote_coleta lc LEFT JOIN lote_triado lt ON lc.id_lote = lt.lote_coleta
""",
    "not_exists_one_level": """
SELECT lc.id_lote, lc.cidade, lc.estado FROM lote_coleta lc
WHERE NOT EXISTS (SELECT 1 FROM lote_triado lt WHERE lt.lote_coleta = lc.id_lote)
""",
    "subtype_semi_filter": """
SELECT t.cod_rastreio, t.transportadora, t.data_envio, t.data_chegada
FROM transporte t JOIN transporte_coleta_tri tct ON t.cod_rastreio = tct.cod_rastreio
""",
    "sum_by_three_keys": """
SELECT cnpj, nome, licenca_ambiental, CAST(volume_total AS DOUBLE) AS volume_total
FROM volume_por_centro
""",
    "avg_of_group_sums": """
SELECT COUNT(volume_total) AS n_centres,
       CAST(SUM(volume_total) AS DOUBLE) AS total_volume,
       CAST(ROUND(AVG(volume_total), 6) AS DOUBLE) AS avg_volume
FROM volume_por_centro
""",
    "distinct_points": "SELECT DISTINCT rua, cidade, cep, estado FROM lote_coleta",
    "transit_days": """
SELECT cod_rastreio, CAST(data_chegada - data_envio AS INTEGER) AS dias FROM transporte
""",
    "option_labels": """
SELECT 'point' AS kind, CAST(to_json({'rua': rua, 'cidade': cidade, 'cep': cep, 'estado': estado}) AS VARCHAR) AS option_key,
       rua || ' — ' || cidade || '/' || estado AS label
FROM ponto_coleta
UNION ALL
SELECT 'lot', CAST(id_lote AS VARCHAR),
       '#' || CAST(id_lote AS VARCHAR) || ' — ' || cidade || '/' || estado
         || ' (' || strftime(data_coleta, '%Y-%m-%d') || ')'
FROM lote_coleta
UNION ALL
SELECT 'device', nome,
       nome || ' (' || categoria || ', ' || regexp_replace(CAST(peso_medio AS VARCHAR), '\\.?0+$', '') || ' kg)'
FROM dispositivo_eletronico
UNION ALL
SELECT 'material', nome, nome || ' — ' || tipo_material FROM material
""",
}

# Volumes are summed per transport before they reach a centre.
VOLUME_CTE = """
volume_por_centro AS (
  SELECT cnpj, nome, licenca_ambiental, SUM(leg_volume) AS volume_total
  FROM (SELECT transporte_tri_reciclagem AS cod_rastreio, SUM(peso_exato) AS leg_volume
        FROM lote_triado GROUP BY ALL) per_leg
  JOIN (SELECT cod_rastreio, centro_reciclagem AS cnpj FROM transporte_tri_reciclagem) legs
    USING (cod_rastreio)
  JOIN (SELECT * FROM centro_reciclagem WHERE licenca_ambiental IS NOT NULL) licensed USING (cnpj)
  GROUP BY ALL)
"""


# Date columns of the compared outputs, rendered as ISO text on both sides.
DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "lots_without_sorting": ("data_coleta", "chegada_ao_centro"),
    "list_lots": ("data_coleta",),
    "join_inner_composite2": ("data_processamento",),
    "subtype_semi_filter": ("data_envio", "data_chegada"),
    "transport_unified": ("data_envio", "data_chegada"),
}


def _iso_dates(key: str, sql: str) -> str:
    cols = DATE_COLUMNS.get(key)
    if not cols:
        return sql
    replace = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in cols)
    return f"SELECT * REPLACE ({replace}) FROM (\n{sql}\n) q"


def oracle_sql() -> dict[str, str]:
    out = _oracle_sql()
    return {k: _iso_dates(k, v) for k, v in out.items()}


def _oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    volume_users = {"centres_above_average", "sum_by_three_keys", "avg_of_group_sums"}
    for key, body in {**REPORTS, **LISTINGS, **OPERATORS}.items():
        extra = VOLUME_CTE if key in volume_users else ""
        out[key] = with_domain(body, extra)
    out["result_count"] = with_domain(
        " UNION ALL ".join(
            f"SELECT '{k}' AS report, COUNT(*) AS n_rows FROM ({REPORTS[k].strip()}) q_{i}"
            for i, k in enumerate(REPORT_KEYS)
        ),
        VOLUME_CTE,
    )
    out.update(quality_sql())
    out.update(ingest_sql())
    return out


# ------------------------------------------------------------------ checks
# Generated from the table catalogue: one SELECT per constraint, each an
# independent DuckDB scan (no shared aggregation with the Spark side).


def _faulty_ref(table: str, faulty: bool = True) -> str:
    from revtrace.sources.faults import FAULTY_TABLES

    return f"{table}_f" if faulty and table in FAULTY_TABLES else table


def _check_sql(kind: str, faulty: bool = True) -> str:
    from revtrace.schema import TABLES

    parts = []
    for name, t in TABLES.items():
        ref = _faulty_ref(name, faulty)
        if kind == "not_null":
            for c in t.columns:
                if not c.nullable:
                    parts.append(
                        f"SELECT '{name}' AS table_name, 'nn_{name}_{c.name}' AS constraint_name, "
                        f"CAST(COUNT(*) FILTER (WHERE {c.name} IS NULL) AS BIGINT) AS violations "
                        f"FROM {ref}"
                    )
        elif kind == "length":
            for c in t.columns:
                if c.length is not None:
                    parts.append(
                        f"SELECT '{name}' AS table_name, 'len_{name}_{c.name}' AS constraint_name, "
                        f"CAST(COUNT(*) FILTER (WHERE length(rtrim({c.name})) > {c.length}) AS BIGINT) "
                        f"AS violations FROM {ref}"
                    )
        elif kind in ("primary_key", "unique"):
            keys = (
                [(t.pk_name, t.primary_key)]
                if kind == "primary_key"
                else [(u.name, u.columns) for u in t.uniques]
            )
            for cname, cols in keys:
                null_key = " OR ".join(f"{c} IS NULL" for c in cols)
                null_rows = "n" if kind == "primary_key" else "0"
                parts.append(
                    f"SELECT '{name}' AS table_name, '{cname}' AS constraint_name, "
                    f"CAST(COUNT(*) FILTER (WHERE NOT null_key AND n > 1) AS BIGINT) AS duplicate_groups, "
                    f"CAST(COALESCE(SUM(CASE WHEN null_key THEN {null_rows} "
                    f"WHEN n > 1 THEN n - 1 ELSE 0 END), 0) AS BIGINT) AS violations "
                    f"FROM (SELECT ({null_key}) AS null_key, COUNT(*) AS n FROM {ref} "
                    f"GROUP BY {', '.join(cols)}) g"
                )
        elif kind == "foreign_key":
            for fk in t.foreign_keys:
                pref = _faulty_ref(fk.parent, faulty)
                not_null = " AND ".join(f"c.{c} IS NOT NULL" for c in fk.columns)
                match = " AND ".join(
                    f"p.{p} = c.{c}" for c, p in zip(fk.columns, fk.parent_columns)
                )
                parts.append(
                    f"SELECT '{name}' AS table_name, '{fk.name}' AS constraint_name, "
                    f"'{fk.parent}' AS parent_table, CAST(COUNT(*) AS BIGINT) AS violations "
                    f"FROM {ref} c WHERE {not_null} "
                    f"AND NOT EXISTS (SELECT 1 FROM {pref} p WHERE {match})"
                )
    return "\nUNION ALL\n".join(parts)


DELETES: dict[str, str] = {
    "cascade_delete": """
SELECT 'lote_coleta' AS table_name, 'deleted' AS effect, COUNT(*) AS affected_rows FROM del_lc
UNION ALL SELECT 'qtd_produto_lote', 'deleted', COUNT(*) FROM qtd_produto_lote
  WHERE lote IN (SELECT id_lote FROM del_lc)
UNION ALL SELECT 'lote_triado', 'deleted', COUNT(*) FROM del_lt
UNION ALL SELECT 'processo_reciclagem', 'deleted', COUNT(*) FROM del_pr
UNION ALL SELECT 'material_processado', 'deleted', COUNT(*) FROM material_processado mp
  WHERE EXISTS (SELECT 1 FROM del_pr d WHERE d.data_processamento = mp.data_processamento
                AND d.tipo_de_processamento = mp.tipo_de_processamento)
""",
    "set_null_on_delete": """
SELECT 'transporte' AS table_name, 'deleted' AS effect, COUNT(*) AS affected_rows FROM del_t
UNION ALL SELECT 'transporte_coleta_tri', 'deleted', COUNT(*) FROM transporte_coleta_tri
  WHERE cod_rastreio IN (SELECT cod_rastreio FROM del_t)
UNION ALL SELECT 'transporte_tri_reciclagem', 'deleted', COUNT(*) FROM transporte_tri_reciclagem
  WHERE cod_rastreio IN (SELECT cod_rastreio FROM del_t)
UNION ALL SELECT 'lote_coleta', 'set_null', COUNT(*) FROM lote_coleta
  WHERE transporte IN (SELECT cod_rastreio FROM transporte_coleta_tri
                       WHERE cod_rastreio IN (SELECT cod_rastreio FROM del_t))
UNION ALL SELECT 'lote_triado', 'set_null', COUNT(*) FROM lote_triado
  WHERE transporte_tri_reciclagem IN (SELECT cod_rastreio FROM transporte_tri_reciclagem
                                      WHERE cod_rastreio IN (SELECT cod_rastreio FROM del_t))
""",
    "restrict_delete": """
SELECT * FROM (
  SELECT 'dispositivo_eletronico' AS table_name, 'fk_disp_categoria' AS constraint_name,
         'categoria' AS parent_table, COUNT(*) AS referencing_rows
  FROM dispositivo_eletronico WHERE categoria IN (SELECT nome FROM categoria)
  UNION ALL
  SELECT 'lote_triado', 'fk_lote_triado_categoria', 'categoria', COUNT(*)
  FROM lote_triado WHERE categoria IN (SELECT nome FROM categoria)) b
WHERE referencing_rows > 0
""",
}

DELETE_CTES = {
    "cascade_delete": """
del_lc AS (SELECT id_lote FROM lote_coleta WHERE id_lote % 10 = 0),
del_lt AS (SELECT lote_coleta, pin_lote_tri FROM lote_triado
           WHERE lote_coleta IN (SELECT id_lote FROM del_lc)),
del_pr AS (SELECT data_processamento, tipo_de_processamento FROM processo_reciclagem pr
           WHERE EXISTS (SELECT 1 FROM del_lt d WHERE d.lote_coleta = pr.lote_coleta
                         AND d.pin_lote_tri = pr.pin_lote_tri))
""",
    "set_null_on_delete": """
del_t AS (SELECT cod_rastreio FROM transporte
          WHERE cod_rastreio LIKE 'CT-%'
            AND TRY_CAST(substr(cod_rastreio, 4) AS BIGINT) % 10 = 0)
""",
    "restrict_delete": "",
}

TRANSPORT_UNIFIED = """
SELECT t.cod_rastreio, t.transportadora, t.data_envio, t.data_chegada,
       CASE WHEN tct.cod_rastreio IS NOT NULL AND ttr.cod_rastreio IS NOT NULL THEN 'both'
            WHEN tct.cod_rastreio IS NOT NULL THEN 'coleta_triagem'
            WHEN ttr.cod_rastreio IS NOT NULL THEN 'triagem_reciclagem' END AS leg,
       COALESCE(tct.centro_triagem, ttr.centro_reciclagem) AS destino,
       ttr.mtr
FROM transporte t
LEFT JOIN transporte_coleta_tri tct ON t.cod_rastreio = tct.cod_rastreio
LEFT JOIN transporte_tri_reciclagem ttr ON t.cod_rastreio = ttr.cod_rastreio
"""


def quality_sql() -> dict[str, str]:
    from revtrace.sources.faults import FAULTY_VIEWS_SQL

    out = {
        f"check_{k}": with_domain(_check_sql(k), FAULTY_VIEWS_SQL)
        for k in ("not_null", "length", "primary_key", "unique", "foreign_key")
    }
    for k, body in DELETES.items():
        out[k] = with_domain(body, DELETE_CTES[k])
    out["transport_unified"] = with_domain(TRANSPORT_UNIFIED)
    out["full_reload_report"] = _reload_sql()
    return out


def _reload_sql() -> str:
    from revtrace.schema import TABLES, load_levels, load_order

    levels = load_levels()
    meta = ", ".join(
        f"('{t}', {i + 1}, {levels[t]})" for i, t in enumerate(load_order())
    )
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in TABLES
    )
    ctes = ",\n".join(
        [
            f"chk_not_null AS ({_check_sql('not_null', False)})",
            f"chk_too_long AS ({_check_sql('length', False)})",
            "chk_duplicate_key AS ("
            f"SELECT table_name, violations FROM ({_check_sql('primary_key', False)}) a "
            f"UNION ALL SELECT table_name, violations FROM ({_check_sql('unique', False)}) b)",
            f"chk_foreign_key AS ({_check_sql('foreign_key', False)})",
            f"meta AS (SELECT * FROM (VALUES {meta}) v(table_name, load_order, level))",
            f"row_counts AS ({counts})",
        ]
    )
    rules = ["not_null", "too_long", "duplicate_key", "foreign_key"]
    cols = ",\n".join(
        f"CAST(COALESCE((SELECT SUM(c.violations) FROM chk_{r} c "
        f"WHERE c.table_name = m.table_name), 0) AS BIGINT) AS {r}"
        for r in rules
    )
    body = f"""
SELECT table_name, load_order, level, rows, {", ".join(rules)},
       ({" AND ".join(f"{r} = 0" for r in rules)}) AS publishable
FROM (SELECT m.table_name, CAST(m.load_order AS INTEGER) AS load_order,
             CAST(m.level AS INTEGER) AS level, rc.n_rows AS rows,
{cols}
      FROM meta m JOIN row_counts rc ON m.table_name = rc.table_name) x
ORDER BY load_order
"""
    return with_domain(body, ctes)


# ------------------------------------------------------------------ ingest
# Same rules as revtrace.operators.ingest, written as set SQL. First-wins
# over two unique keys is replayed row by row here: a recursion walks the lots
# that contest a key in arrival order and carries the keys taken so far.

INGEST_POINTS_CTES = """
prep_points AS (
  SELECT submit_seq, rua, cidade, rtrim(cep) AS cep,
         rtrim(upper(substr(estado, 1, 2))) AS estado,
         CASE WHEN regexp_full_match(regexp_replace(capacidade_max, '^\\s+|\\s+$', '', 'g'), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)')
               AND length(rtrim(regexp_extract(regexp_replace(capacidade_max, '^\\s+|\\s+$', '', 'g'), '\\.([0-9]*)', 1), '0')) <= 6
              THEN TRY_CAST(regexp_replace(capacidade_max, '^\\s+|\\s+$', '', 'g') AS DECIMAL(28,6)) END AS cap,
         CASE WHEN regexp_full_match(regexp_replace(capacidade_max, '^\\s+|\\s+$', '', 'g'), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)')
              THEN '22003' ELSE '22P02' END AS cap_state,
         concat_ws(', ',
           CASE WHEN rua IS NULL OR rua = '' THEN 'rua' END,
           CASE WHEN cidade IS NULL OR cidade = '' THEN 'cidade' END,
           CASE WHEN cep IS NULL OR cep = '' THEN 'cep' END,
           CASE WHEN estado IS NULL OR estado = '' THEN 'estado' END,
           CASE WHEN capacidade_max IS NULL OR capacidade_max = '' THEN 'capacidade_max' END
         ) AS missing
  FROM sub_points),
cls_points AS (
  SELECT *,
         concat_ws(', ',
           CASE WHEN length(rtrim(rua)) > 100 THEN 'rua' END,
           CASE WHEN length(rtrim(cidade)) > 50 THEN 'cidade' END,
           CASE WHEN length(rtrim(cep)) > 8 THEN 'cep' END,
           CASE WHEN length(rtrim(estado)) > 2 THEN 'estado' END) AS long_cols
  FROM prep_points),
st_points AS (
  SELECT *,
         CASE WHEN missing <> '' THEN 'missing'
              WHEN cap IS NULL THEN 'type'
              WHEN long_cols <> '' THEN 'too_long' END AS static_reason,
         EXISTS (SELECT 1 FROM ponto_coleta p WHERE p.rua = c.rua AND p.cidade = c.cidade
                 AND p.cep = c.cep AND p.estado = c.estado) AS ex_pk
  FROM cls_points c),
acc_points AS (
  SELECT rua, cidade, cep, estado, MIN(submit_seq) AS acc_pk
  FROM st_points WHERE static_reason IS NULL AND NOT ex_pk
  GROUP BY rua, cidade, cep, estado),
out_points AS (
  SELECT s.submit_seq,
         CASE WHEN s.static_reason IS NOT NULL THEN s.static_reason
              WHEN s.ex_pk OR a.acc_pk < s.submit_seq THEN 'duplicate_key' END AS reason,
         CASE WHEN s.static_reason = 'missing' THEN s.missing
              WHEN s.static_reason = 'type' THEN 'capacidade_max'
              WHEN s.static_reason = 'too_long' THEN s.long_cols
              WHEN s.ex_pk OR a.acc_pk < s.submit_seq THEN 'pk_ponto_coleta' END AS detail,
         CASE WHEN s.static_reason = 'type' THEN cap_state
              WHEN s.static_reason = 'too_long' THEN '22001'
              WHEN s.static_reason IS NULL AND (s.ex_pk OR a.acc_pk < s.submit_seq)
                THEN '23505' END AS sqlstate
  FROM st_points s
  LEFT JOIN acc_points a ON s.rua = a.rua AND s.cidade = a.cidade
                        AND s.cep = a.cep AND s.estado = a.estado)
"""

INGEST_LOTS_CTES = """
prep_lots AS (
  SELECT submit_seq,
         CASE WHEN regexp_full_match(regexp_replace(id_lote, '^\\s+|\\s+$', '', 'g'), '[+-]?[0-9]+')
              THEN TRY_CAST(regexp_replace(id_lote, '^\\s+|\\s+$', '', 'g') AS BIGINT) END AS id,
         rua, cidade, rtrim(cep) AS cep, rtrim(upper(substr(estado, 1, 2))) AS estado,
         CAST(TRY_STRPTIME(regexp_replace(data_coleta, '^\\s+|\\s+$', '', 'g'), '%Y-%m-%d') AS DATE) AS data,
         concat_ws(', ',
           CASE WHEN id_lote IS NULL OR regexp_replace(id_lote, '^\\s+|\\s+$', '', 'g') = '' THEN 'id_lote' END,
           CASE WHEN rua IS NULL OR regexp_replace(rua, '^\\s+|\\s+$', '', 'g') = '' THEN 'rua' END,
           CASE WHEN cidade IS NULL OR regexp_replace(cidade, '^\\s+|\\s+$', '', 'g') = '' THEN 'cidade' END,
           CASE WHEN cep IS NULL OR regexp_replace(cep, '^\\s+|\\s+$', '', 'g') = '' THEN 'cep' END,
           CASE WHEN estado IS NULL OR regexp_replace(estado, '^\\s+|\\s+$', '', 'g') = '' THEN 'estado' END,
           CASE WHEN data_coleta IS NULL OR regexp_replace(data_coleta, '^\\s+|\\s+$', '', 'g') = '' THEN 'data_coleta' END
         ) AS missing
  FROM sub_lots),
st_lots AS (
  SELECT c.*,
         concat_ws(', ',
           CASE WHEN length(rtrim(rua)) > 100 THEN 'rua' END,
           CASE WHEN length(rtrim(cidade)) > 50 THEN 'cidade' END,
           CASE WHEN length(rtrim(cep)) > 8 THEN 'cep' END,
           CASE WHEN length(rtrim(estado)) > 2 THEN 'estado' END) AS long_cols,
         (EXISTS (SELECT 1 FROM ponto_coleta p WHERE p.rua = c.rua AND p.cidade = c.cidade
                  AND p.cep = c.cep AND p.estado = c.estado)
          OR EXISTS (SELECT 1 FROM acc_points p WHERE p.rua = c.rua AND p.cidade = c.cidade
                     AND p.cep = c.cep AND p.estado = c.estado
                     AND p.acc_pk < c.submit_seq)) AS fk_ok,
         EXISTS (SELECT 1 FROM lote_coleta l WHERE l.id_lote = c.id) AS ex_pk,
         EXISTS (SELECT 1 FROM lote_coleta l WHERE l.rua = c.rua AND l.cidade = c.cidade
                 AND l.cep = c.cep AND l.estado = c.estado
                 AND l.data_coleta = c.data) AS ex_nk
  FROM prep_lots c),
st2_lots AS (
  SELECT *,
         CASE WHEN missing <> '' THEN 'missing'
              WHEN id IS NULL OR data IS NULL THEN 'type'
              WHEN long_cols <> '' THEN 'too_long' END AS static_reason
  FROM st_lots),
pool_lots AS (
  SELECT * FROM st2_lots
  WHERE static_reason IS NULL AND fk_ok AND NOT ex_pk AND NOT ex_nk),
keyed_lots AS (
  SELECT *, rua || chr(0) || cidade || chr(0) || cep || chr(0) || estado || chr(0) || data AS nk
  FROM pool_lots),
counted_lots AS (
  SELECT *, COUNT(*) OVER (PARTITION BY id) AS n_id, COUNT(*) OVER (PARTITION BY nk) AS n_nk
  FROM keyed_lots),
beside_lots AS (
  SELECT a.submit_seq AS a, b.submit_seq AS b FROM counted_lots a JOIN counted_lots b ON a.id = b.id
  WHERE a.n_id > 1
  UNION
  SELECT a.submit_seq, b.submit_seq FROM counted_lots a JOIN counted_lots b ON a.nk = b.nk
  WHERE a.n_nk > 1),
reach_lots AS (
  SELECT a, b FROM beside_lots
  UNION
  SELECT r.a, n.b FROM reach_lots r JOIN beside_lots n ON n.a = r.b),
turn_lots AS (
  SELECT c.submit_seq, c.id, c.nk, g.comp,
         row_number() OVER (PARTITION BY g.comp ORDER BY c.submit_seq) AS rn
  FROM counted_lots c
  JOIN (SELECT a, MIN(b) AS comp FROM reach_lots GROUP BY a) g ON g.a = c.submit_seq),
walk_lots AS (
  SELECT DISTINCT comp, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS ids,
         CAST([] AS VARCHAR[]) AS nks, CAST(NULL AS BIGINT) AS taken
  FROM turn_lots
  UNION ALL
  SELECT t.comp, t.rn,
         CASE WHEN list_contains(w.ids, t.id) OR list_contains(w.nks, t.nk) THEN w.ids
              ELSE list_append(w.ids, t.id) END,
         CASE WHEN list_contains(w.ids, t.id) OR list_contains(w.nks, t.nk) THEN w.nks
              ELSE list_append(w.nks, t.nk) END,
         CASE WHEN list_contains(w.ids, t.id) OR list_contains(w.nks, t.nk) THEN NULL
              ELSE t.submit_seq END
  FROM walk_lots w JOIN turn_lots t ON t.comp = w.comp AND t.rn = w.rn + 1),
acc_lots AS (
  SELECT * FROM counted_lots
  WHERE (n_id = 1 AND n_nk = 1) OR submit_seq IN (SELECT taken FROM walk_lots)),
dec_lots AS (
  SELECT s.*,
         (s.ex_pk OR a1.submit_seq < s.submit_seq) AS c_pk,
         (s.ex_nk OR a2.submit_seq < s.submit_seq) AS c_nk
  FROM st2_lots s
  LEFT JOIN acc_lots a1 ON s.id = a1.id
  LEFT JOIN acc_lots a2 ON s.rua = a2.rua AND s.cidade = a2.cidade AND s.cep = a2.cep
                       AND s.estado = a2.estado AND s.data = a2.data),
out_lots AS (
  SELECT submit_seq,
         CASE WHEN static_reason IS NOT NULL THEN static_reason
              WHEN c_pk OR c_nk THEN 'duplicate_key'
              WHEN NOT fk_ok THEN 'foreign_key' END AS reason,
         CASE WHEN static_reason = 'missing' THEN missing
              WHEN static_reason = 'type' THEN CASE WHEN id IS NULL THEN 'id_lote' ELSE 'data_coleta' END
              WHEN static_reason = 'too_long' THEN long_cols
              WHEN c_pk THEN 'pk_lote_coleta'
              WHEN c_nk THEN 'uq_chave_natural_lote'
              WHEN NOT fk_ok THEN 'fk_lote_ponto_coleta' END AS detail,
         CASE WHEN static_reason = 'type' THEN CASE WHEN id IS NULL THEN '22P02' ELSE '22007' END
              WHEN static_reason = 'too_long' THEN '22001'
              WHEN static_reason IS NOT NULL THEN NULL
              WHEN c_pk OR c_nk THEN '23505'
              WHEN NOT fk_ok THEN '23503' END AS sqlstate
  FROM dec_lots)
"""

INGEST_DEVICES_CTES = """
prep_dev AS (
  SELECT submit_seq,
         CASE WHEN regexp_full_match(regexp_replace(id_lote, '^\\s+|\\s+$', '', 'g'), '[+-]?[0-9]+')
              THEN TRY_CAST(regexp_replace(id_lote, '^\\s+|\\s+$', '', 'g') AS BIGINT) END AS lote,
         dispositivo,
         CASE WHEN regexp_full_match(regexp_replace(quantidade, '^\\s+|\\s+$', '', 'g'), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)')
               AND length(rtrim(regexp_extract(regexp_replace(quantidade, '^\\s+|\\s+$', '', 'g'), '\\.([0-9]*)', 1), '0')) <= 6
              THEN TRY_CAST(regexp_replace(quantidade, '^\\s+|\\s+$', '', 'g') AS DECIMAL(28,6)) END AS qty,
         CASE WHEN regexp_full_match(regexp_replace(quantidade, '^\\s+|\\s+$', '', 'g'), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)')
              THEN '22003' ELSE '22P02' END AS qty_state,
         concat_ws(', ',
           CASE WHEN id_lote IS NULL OR regexp_replace(id_lote, '^\\s+|\\s+$', '', 'g') = '' THEN 'id_lote' END,
           CASE WHEN dispositivo IS NULL OR regexp_replace(dispositivo, '^\\s+|\\s+$', '', 'g') = '' THEN 'dispositivo' END,
           CASE WHEN quantidade IS NULL OR regexp_replace(quantidade, '^\\s+|\\s+$', '', 'g') = '' THEN 'quantidade' END
         ) AS missing
  FROM sub_devices),
lot_parents AS (
  SELECT id_lote, CAST(-1 AS BIGINT) AS since FROM lote_coleta
  UNION ALL SELECT id, submit_seq FROM acc_lots),
st_dev AS (
  SELECT c.*,
         CASE WHEN missing <> '' THEN 'missing'
              WHEN lote IS NULL OR qty IS NULL THEN 'type'
              WHEN length(rtrim(dispositivo)) > 100 THEN 'too_long' END AS static_reason,
         EXISTS (SELECT 1 FROM lot_parents l
                 WHERE l.id_lote = c.lote AND l.since < c.submit_seq) AS fk_lote_ok,
         EXISTS (SELECT 1 FROM dispositivo_eletronico d WHERE d.nome = c.dispositivo) AS fk_dev_ok,
         EXISTS (SELECT 1 FROM qtd_produto_lote q WHERE q.lote = c.lote
                 AND q.dispositivo_eletronico = c.dispositivo) AS ex_pk
  FROM prep_dev c),
acc_dev AS (
  SELECT lote, dispositivo, MIN(submit_seq) AS acc_pk FROM st_dev
  WHERE static_reason IS NULL AND fk_lote_ok AND fk_dev_ok AND NOT ex_pk
  GROUP BY lote, dispositivo),
out_devices AS (
  SELECT s.submit_seq,
         CASE WHEN s.static_reason IS NOT NULL THEN s.static_reason
              WHEN s.ex_pk OR a.acc_pk < s.submit_seq THEN 'duplicate_key'
              WHEN NOT (s.fk_lote_ok AND s.fk_dev_ok) THEN 'foreign_key' END AS reason,
         CASE WHEN s.static_reason = 'missing' THEN s.missing
              WHEN s.static_reason = 'type'
                THEN CASE WHEN s.lote IS NULL THEN 'id_lote' ELSE 'quantidade' END
              WHEN s.static_reason = 'too_long' THEN 'dispositivo_eletronico'
              WHEN s.ex_pk OR a.acc_pk < s.submit_seq THEN 'pk_qtd_produto_lote'
              WHEN NOT s.fk_lote_ok THEN 'fk_qtd_lote'
              WHEN NOT s.fk_dev_ok THEN 'fk_qtd_dispositivo' END AS detail,
         CASE WHEN s.static_reason = 'type'
                THEN CASE WHEN s.lote IS NULL THEN '22P02' ELSE qty_state END
              WHEN s.static_reason = 'too_long' THEN '22001'
              WHEN s.static_reason IS NOT NULL THEN NULL
              WHEN s.ex_pk OR a.acc_pk < s.submit_seq THEN '23505'
              WHEN NOT (s.fk_lote_ok AND s.fk_dev_ok) THEN '23503' END AS sqlstate
  FROM st_dev s
  LEFT JOIN acc_dev a ON s.lote = a.lote AND s.dispositivo = a.dispositivo)
"""


def _outcomes(cte: str) -> str:
    return (
        "SELECT submit_seq, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END "
        f"AS outcome, reason, sqlstate, detail FROM {cte}"
    )


def ingest_sql() -> dict[str, str]:
    from revtrace.sources.submissions import (
        LOT_DEVICE_SUBMISSIONS_SQL,
        LOT_SUBMISSIONS_SQL,
        POINT_SUBMISSIONS_SQL,
    )

    points = POINT_SUBMISSIONS_SQL.strip() + ",\n" + INGEST_POINTS_CTES.strip()
    lots = points + ",\n" + LOT_SUBMISSIONS_SQL.strip() + ",\n" + INGEST_LOTS_CTES.strip()
    devices = lots + ",\n" + LOT_DEVICE_SUBMISSIONS_SQL.strip() + ",\n" + INGEST_DEVICES_CTES.strip()
    stream_body = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, * FROM ({_outcomes(cte)}) o_{kind}"
        for kind, cte in (("point", "out_points"), ("lot", "out_lots"), ("device", "out_devices"))
    )
    return {
        "ingest_stream": with_domain(stream_body, devices),
        "ingest_points": with_domain(_outcomes("out_points"), points),
        "ingest_lots": with_domain(_outcomes("out_lots"), lots),
        "ingest_lot_devices": with_domain(_outcomes("out_devices"), devices),
        "ingested_points": with_domain(
            "SELECT s.submit_seq, rua, cidade, cep, estado, CAST(cap AS VARCHAR) AS capacidade_max "
            "FROM st_points s JOIN out_points o USING (submit_seq) WHERE o.reason IS NULL",
            points,
        ),
        "ingested_lot_devices": with_domain(
            "SELECT s.submit_seq, lote, dispositivo AS dispositivo_eletronico, "
            "CAST(qty AS VARCHAR) AS quantidade "
            "FROM st_dev s JOIN out_devices o USING (submit_seq) WHERE o.reason IS NULL",
            devices,
        ),
        "normalize_state": with_domain(
            "SELECT submit_seq, estado AS estado_raw, upper(substr(estado, 1, 2)) AS estado "
            "FROM sub_points",
            POINT_SUBMISSIONS_SQL,
        ),
        "missing_fields": with_domain(
            "SELECT submit_seq, missing FROM prep_points", points,
        ),
    }
