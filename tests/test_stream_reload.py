import pytest
from pyspark.sql import functions as F

from support import SMALL_SF, rows
from revtrace.operators import ingest
from revtrace.plans import reload
from revtrace.session import shared_dir
from revtrace.sources import submissions
from revtrace.sources.fixtures import seed_domain
from revtrace.sources.testdata import domain_from_testdata
from revtrace.streaming import feed


def _batch_counts(spark):
    d = domain_from_testdata(spark, SMALL_SF)
    pts = ingest.ingest_points(submissions.point_submissions(spark, SMALL_SF), d.ponto_coleta)
    lots = ingest.ingest_lots(submissions.lot_submissions(spark, SMALL_SF), d.lote_coleta, d.ponto_coleta, pts.arrived)
    devs = ingest.ingest_lot_devices(
        submissions.lot_device_submissions(spark, SMALL_SF),
        d.qtd_produto_lote,
        d.lote_coleta,
        d.dispositivo_eletronico,
        lots.arrived,
    )
    out = {}
    for kind, res in (("point", pts), ("lot", lots), ("device", devs)):
        for r in res.outcomes.groupBy("outcome", "reason").count().collect():
            out[(kind, r[0], r[1])] = r[2]
    return out, {kind: {r[0]: r[1:] for r in rows(res.outcomes)} for kind, res in (("point", pts), ("lot", lots), ("device", devs))}


def _land(spark):
    paths = feed.FeedPaths.fresh(spark)
    feed.land(
        [
            feed.to_feed("point", submissions.point_submissions(spark, SMALL_SF)),
            feed.to_feed("lot", submissions.lot_submissions(spark, SMALL_SF)),
            feed.to_feed("device", submissions.lot_device_submissions(spark, SMALL_SF)),
        ],
        paths.landing,
    )
    return paths


@pytest.fixture(scope="module")
def batch(spark):
    return _batch_counts(spark)


def test_stream_single_batch_equals_batch_ingest(spark, batch):
    counts, per_row = batch
    d = domain_from_testdata(spark, SMALL_SF)
    out = feed.run_feed(spark, d, _land(spark))
    assert out.select("batch_id").distinct().count() == 1
    got = {(r[0], r[1]): r[2:6] for r in rows(out.select("kind", "submit_seq", "outcome", "reason", "sqlstate", "detail"))}
    for kind, m in per_row.items():
        for seq, v in m.items():
            assert got[(kind, seq)] == v


@pytest.mark.parametrize("files_per_trigger", [1, 2])
def test_stream_outcomes_do_not_depend_on_the_cut(spark, files_per_trigger):
    """Files in arrival order, children also before their parents: row by row as in one batch."""
    d = seed_domain(spark)
    sc = ("Av. Trabalhador Sao-carlense, 400", "Sao Carlos", "13566590", "SP")
    new = ("Rua Nova, 1", "Sao Carlos", "13560001", "SP")
    rows_ = [
        ("lot", 1, {"id_lote": "70", "data_coleta": "2026-06-01"}, new),  # before its point
        ("point", 2, {"capacidade_max": "1.125"}, new),
        ("device", 3, {"id_lote": "70", "dispositivo": "Monitor LCD 24 pol", "quantidade": "1"}, None),  # before its lot
        ("lot", 4, {"id_lote": "70", "data_coleta": "2026-06-01"}, new),
        ("point", 5, {"capacidade_max": "1"}, new),  # taken
        ("device", 6, {"id_lote": "70", "dispositivo": "Monitor LCD 24 pol", "quantidade": "1"}, None),
        ("lot", 7, {"id_lote": "71", "data_coleta": "2026-06-01"}, new),  # natural key taken
        ("lot", 8, {"id_lote": "71", "data_coleta": "2026-06-02"}, sc),
        ("device", 9, {"id_lote": "71", "dispositivo": "Monitor LCD 24 pol", "quantidade": "x"}, None),
        ("device", 10, {"id_lote": "70", "dispositivo": "Monitor LCD 24 pol", "quantidade": "2"}, None),
    ]

    def frame(kind, seq, values, point):
        values = dict(values) | (dict(zip(("rua", "cidade", "cep", "estado"), point)) if point else {})
        return spark.createDataFrame([(kind, seq, *[values.get(f) for f in feed.FIELDS])], feed.FEED_SCHEMA)

    frames = [frame(*r) for r in rows_]

    def run(limit):
        paths = feed.FeedPaths.fresh(spark)
        for f in frames:  # one file each, in order
            feed.land([f.coalesce(1)], paths.landing)
        out = feed.run_feed(spark, d, paths, max_files_per_trigger=limit)
        return {(r.kind, r.submit_seq): (r.outcome, r.reason, r.detail) for r in out.collect()}, out

    whole, _ = run(None)
    cut, out = run(files_per_trigger)
    assert out.select("batch_id").distinct().count() == -(-10 // files_per_trigger)
    assert cut == whole
    accepted = {k for k, v in whole.items() if v[0] == "accepted"}
    assert accepted == {("point", 2), ("lot", 4), ("device", 6), ("lot", 8)}
    assert whole["lot", 1][1] == whole["device", 3][1] == "foreign_key"


def test_unreadable_state_is_no_empty_state(spark):
    from pyspark.errors import AnalysisException

    paths = feed.FeedPaths.fresh(spark)
    assert feed._state(spark, paths, "ponto_coleta", 1) is None
    spark.createDataFrame([("x",)], "value string").write.text(f"{paths.state}/ponto_coleta")
    with pytest.raises(Exception) as e:
        feed._state(spark, paths, "ponto_coleta", 1).collect()
    assert not isinstance(e.value, AnalysisException) or e.value.getCondition() != "PATH_NOT_FOUND"


def test_full_reload_publishes_clean_seeds(spark):
    target = shared_dir(spark, "reload-test")
    report = reload.full_reload(seed_domain(spark), target)
    assert all(r.publishable for r in report.collect())
    back = reload.read_published(spark, target)
    assert back.material.count() == 6
    assert back.lote_triado.count() == 3


def test_full_reload_refuses_violations(spark):
    from revtrace.sources.fixtures import SEED_ROWS

    bad = seed_domain(spark, {"material": SEED_ROWS["material"] + [("Cobre", "Outro")]})
    target = shared_dir(spark, "reload-test")
    import os

    from revtrace.session import local_path

    with pytest.raises(reload.ReloadRefused):
        reload.full_reload(bad, target)
    assert os.listdir(local_path(f"{target}/_versions")) == []  # the refused version is gone
    with pytest.raises(reload.ReloadRefused):
        reload.read_published(spark, target)
    # a refused load leaves what was published before
    reload.full_reload(seed_domain(spark), target)
    with pytest.raises(reload.ReloadRefused):
        reload.full_reload(bad, target)
    assert reload.read_published(spark, target).material.count() == 6


def test_a_publication_never_removes_the_one_before(spark):
    """An unfinished publication (a file not yet committed) is invisible; old rows stay readable."""
    target = shared_dir(spark, "reload-test")
    reload.full_reload(seed_domain(spark), target)
    first = reload.published_folders(spark, target)
    reload.full_reload(seed_domain(spark), target)
    number, folders = reload.published_folders(spark, target)
    assert number == first[0] + 1 and folders != first[1]
    markers = spark.read.schema(reload.MARKER).parquet(f"{target}/_markers")
    assert markers.filter("number = 1").count() == 16


def test_delete_is_published_and_replays(spark):
    from revtrace.operators import quality

    target = shared_dir(spark, "delete-test")
    reload.full_reload(seed_domain(spark), target)
    before = reload.read_published(spark, target)
    counts = {t: before[t].count() for t in ("lote_coleta", "lote_triado", "qtd_produto_lote", "material")}
    for _ in range(2):
        d = reload.read_published(spark, target)
        plan = quality.plan_delete(d, "lote_coleta", seed_domain(spark).lote_coleta.filter("id_lote = 1"))
        left = reload.publish_delete(plan, target)
        after = reload.read_published(spark, target)
        assert left["lote_coleta"] == after.lote_coleta.count() == counts["lote_coleta"] - 1
        assert after.lote_triado.filter("lote_coleta = 1").isEmpty()
        assert after.material.count() == counts["material"]
    with pytest.raises(quality.DeleteRefused):
        d = reload.read_published(spark, target)
        reload.publish_delete(quality.plan_delete(d, "categoria", d.categoria), target)
    assert reload.read_published(spark, target).categoria.count() > 0


def test_only_a_local_master_may_lack_a_shared_folder(spark):
    from types import SimpleNamespace

    from revtrace import session

    conf = SimpleNamespace(get=lambda k, d=None: d)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None, getConf=lambda: conf)
        with pytest.raises(RuntimeError):
            session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))


def test_discarded_folders_are_removed(spark):
    import os

    from revtrace.session import discard, local_path, materialize

    df = materialize(spark.range(3), "discard-test")
    assert os.path.exists(local_path(df._revtrace_path))
    discard(df, None, spark.range(1))
    assert not os.path.exists(local_path(df._revtrace_path))


def test_reload_report_flags_natural_key(spark):
    rep = {r.table_name: r for r in reload.reload_report(domain_from_testdata(spark, SMALL_SF)).collect()}
    assert rep["lote_coleta"].duplicate_key >= 1
    assert not rep["lote_coleta"].publishable
    assert rep["categoria"].publishable


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_bucketed_lot_tables_remove_shuffles(spark):
    from revtrace.operators import reports
    from revtrace.sources.store import write_domain

    d = domain_from_testdata(spark, SMALL_SF)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = write_domain(d, shared_dir(spark, "plain"))
        bucketed = write_domain(d, shared_dir(spark, "bucketed"), lot_buckets=8)
        for report in (reports.lots_without_sorting,):
            a, b = report(plain), report(bucketed)
            assert sorted(rows(a)) == sorted(rows(b))
            assert _exchanges(b) < _exchanges(a)
        lots_plain = plain.lote_coleta.join(
            plain.lote_triado.withColumnRenamed("lote_coleta", "id_lote").select("id_lote").distinct(),
            "id_lote",
            "left_anti",
        )
        lots_b = bucketed.lote_coleta.join(
            bucketed.lote_triado.withColumnRenamed("lote_coleta", "id_lote").select("id_lote").distinct(),
            "id_lote",
            "left_anti",
        )
        assert _exchanges(lots_b) == 0 < _exchanges(lots_plain)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_replayed_batch_is_idempotent(spark):
    """Running the same micro-batch twice (a replay) gives the same outcomes."""
    from revtrace.sources.fixtures import seed_domain

    d = seed_domain(spark)
    paths = feed.FeedPaths.fresh(spark)
    sub = spark.createDataFrame(
        [(1, "Rua Nova, 1", "Sao Carlos", "13560001", "SP", "10")],
        "submit_seq long, rua string, cidade string, cep string, estado string, capacidade_max string",
    )
    batch = feed.to_feed("point", sub)
    feed._process_batch(spark, paths, d, batch, 0)
    first = rows(feed.read_outcomes(spark, paths).select("outcome"))
    feed._process_batch(spark, paths, d, batch, 0)  # replay of batch 0
    again = rows(feed.read_outcomes(spark, paths).select("outcome"))
    assert first == again == [("accepted",)]
    feed._process_batch(spark, paths, d, batch.withColumn("submit_seq", F.lit(2).cast("long")), 1)
    later = {r[0]: r[1] for r in rows(feed.read_outcomes(spark, paths).select("batch_id", "reason"))}
    assert later == {0: None, 1: "duplicate_key"}
