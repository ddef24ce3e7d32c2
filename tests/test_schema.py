from revtrace.schema import TABLES, foreign_keys, load_levels, load_order


def test_catalogue_counts():
    assert len(TABLES) == 16
    cols = [c for t in TABLES.values() for c in t.columns]
    assert len(cols) == 68
    assert sum(not c.nullable for c in cols) == 63
    assert sum(len(t.uniques) for t in TABLES.values()) == 4
    fks = foreign_keys()
    assert len(fks) == 17
    actions = [fk.on_delete for _, fk in fks]
    assert actions.count("cascade") == 7
    assert actions.count("set_null") == 2
    assert actions.count("no_action") == 8
    assert sum(len(t.primary_key) > 1 for t in TABLES.values()) == 5


def test_load_order_is_topological():
    order = load_order()
    pos = {t: i for i, t in enumerate(order)}
    for child, fk in foreign_keys():
        assert pos[fk.parent] < pos[child]
    levels = load_levels()
    assert levels["categoria"] == 0
    assert levels["material_processado"] == 6
    assert levels["processo_reciclagem"] == 5


def test_fk_columns_exist():
    for child, fk in foreign_keys():
        for c in fk.columns:
            TABLES[child].column(c)
        for c in fk.parent_columns:
            TABLES[fk.parent].column(c)


def test_jdbc_source_names_follow_ddl_case_folding():
    from revtrace.sources.jdbc import source_name

    assert source_name("ponto_coleta") == "pontocoleta"
    assert source_name("capacidade_max") == "capacidademax"
    assert source_name("pin_lote_tri") == "pinlotetri"
