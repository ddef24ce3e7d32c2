"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Every entry reads the test tables under ``sf_dir`` through the domain
mapping, runs the library operator on the whole tables and returns a lazy
DataFrame. For the cross-engine check, decimal columns are cast to double
and dates to ISO text (:mod:`revtrace.plans.oracle` does the same on the
DuckDB side).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.functions.scalar import missing_fields, normalize_state
from revtrace.operators import ingest, listings, quality, relational, reports
from revtrace.plans import reload
from revtrace.session import discard, materialize
from revtrace.sources import submissions
from revtrace.streaming import feed
from revtrace.sources.faults import with_faults
from revtrace.sources.testdata import domain_from_testdata

# Fixed value: the material traced by the registered lineage query, padded as a
# form might send it.
TRACED_MATERIAL = " Brand#1\t"

QueryFn = Callable[[SparkSession, str], DataFrame]


def for_compare(df: DataFrame) -> DataFrame:
    """Cross-engine representation: decimals as double, dates as ISO text.

    The two engines widen decimals differently and hand dates to Python as
    different objects; these two casts make equal values compare equal.
    Everything else is unchanged.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(df[f.name].cast("double").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(df[f.name], "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(df[f.name])
    return df.select(*cols)


def _report(fn: Callable, *args) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return for_compare(fn(domain_from_testdata(spark, sf_dir), *args))

    run.__doc__ = fn.__doc__
    return run


def result_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row count of each report: one row per report (``report``, ``n_rows``)."""
    d = domain_from_testdata(spark, sf_dir)
    runs = {
        "relational_division": reports.relational_division(d),
        "lots_without_sorting": reports.lots_without_sorting(d),
        "centres_above_average": reports.centres_above_average(d),
        "trace_origin_by_material": reports.trace_origin_by_material(d, TRACED_MATERIAL),
        "carrier_mean_transit": reports.carrier_mean_transit(d),
    }
    out = None
    for name, df in runs.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("report"), "n_rows"
        )
        out = c if out is None else out.unionByName(c)
    return out


def _checked(fn: Callable) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(with_faults(domain_from_testdata(spark, sf_dir)))

    run.__doc__ = fn.__doc__
    return run


def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete every tenth lot (by id) and report the cascaded deletions."""
    d = domain_from_testdata(spark, sf_dir)
    doomed = d.lote_coleta.filter(F.col("id_lote") % 10 == 0)
    return quality.plan_delete(d, "lote_coleta", doomed).summary()


def set_null_on_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete every tenth first-leg transport; lots lose their transport."""
    d = domain_from_testdata(spark, sf_dir)
    code = F.col("cod_rastreio")
    doomed = d.transporte.filter(
        code.startswith("CT-") & (F.substring(code, 4, 64).try_cast("long") % 10 == 0)
    )
    return quality.plan_delete(d, "transporte", doomed).summary()


def restrict_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Try to delete every category: the NO ACTION keys that refuse it."""
    d = domain_from_testdata(spark, sf_dir)
    return quality.plan_delete(d, "categoria", d.categoria).blocking


def normalize_state_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State field of the point submissions, raw and normalised."""
    sub = submissions.point_submissions(spark, sf_dir)
    return sub.select(
        "submit_seq",
        F.col("estado").alias("estado_raw"),
        normalize_state("estado").alias("estado"),
    )


def missing_fields_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required-field message of every point submission ('' when complete)."""
    sub = submissions.point_submissions(spark, sf_dir)
    return sub.select(
        "submit_seq",
        missing_fields(ingest.POINTS.required, ingest.POINTS.blank_is_missing).alias(
            "missing"
        ),
    )


def _points_result(spark: SparkSession, sf_dir: str):
    d = domain_from_testdata(spark, sf_dir)
    sub = submissions.point_submissions(spark, sf_dir)
    return d, ingest.ingest_points(sub, d.ponto_coleta)


def _lots_result(spark: SparkSession, sf_dir: str):
    d, points = _points_result(spark, sf_dir)
    sub = submissions.lot_submissions(spark, sf_dir)
    lots = ingest.ingest_lots(sub, d.lote_coleta, d.ponto_coleta, points.arrived)
    points.discard()
    return d, lots


def _lot_devices_result(spark: SparkSession, sf_dir: str):
    d, lots = _lots_result(spark, sf_dir)
    sub = submissions.lot_device_submissions(spark, sf_dir)
    devices = ingest.ingest_lot_devices(
        sub, d.qtd_produto_lote, d.lote_coleta, d.dispositivo_eletronico, lots.arrived
    )
    lots.discard()
    return devices


def ingest_points_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classify point submissions against the existing points."""
    return _points_result(spark, sf_dir)[1].outcomes


def ingested_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted point rows; the capacity as text, every digit of it."""
    rows = _points_result(spark, sf_dir)[1].arrived
    return rows.withColumn("capacidade_max", F.col("capacidade_max").cast("string"))


def ingest_lots_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classify lot submissions (two unique keys, point foreign key) after the point feed of the same run."""
    return _lots_result(spark, sf_dir)[1].outcomes


def ingest_lot_devices_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classify device-in-lot submissions after the point and lot feeds of the same run."""
    return _lot_devices_result(spark, sf_dir).outcomes


def ingested_lot_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The accepted device-in-lot rows; the quantity as text, every digit of it."""
    rows = _lot_devices_result(spark, sf_dir).arrived
    return rows.withColumn("quantidade", F.col("quantidade").cast("string"))


def full_reload_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validation report of a full reload of all sixteen tables; the line-item groups are worked out once."""
    kept = []

    def keep(groups: DataFrame) -> DataFrame:
        kept.append(materialize(groups, "line-groups"))
        return kept[-1]

    report = reload.reload_report(domain_from_testdata(spark, sf_dir, keep))
    discard(*kept)
    return report


def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the three submission feeds through the streaming ingest.

    The feeds are landed as Parquet under a fresh folder of the shared
    checkpoint area (points, then lots, then lot devices) and drained with
    an available-now trigger; the outcomes of every micro-batch are
    returned. (Multi-batch runs are exercised by the tests.)
    """
    d = domain_from_testdata(spark, sf_dir)
    paths = feed.FeedPaths.fresh(spark)
    feed.land(
        [
            feed.to_feed("point", submissions.point_submissions(spark, sf_dir)),
            feed.to_feed("lot", submissions.lot_submissions(spark, sf_dir)),
            feed.to_feed("device", submissions.lot_device_submissions(spark, sf_dir)),
        ],
        paths.landing,
    )
    return feed.run_feed(spark, d, paths).drop("batch_id")


def queries() -> dict[str, QueryFn]:
    return {
        "relational_division": _report(reports.relational_division),
        "lots_without_sorting": _report(reports.lots_without_sorting),
        "centres_above_average": _report(reports.centres_above_average),
        "trace_origin_by_material": _report(
            reports.trace_origin_by_material, TRACED_MATERIAL
        ),
        "carrier_mean_transit": _report(reports.carrier_mean_transit),
        "list_collection_points": _report(listings.list_collection_points),
        "list_devices": _report(listings.list_devices),
        "list_lots": _report(listings.list_lots),
        "list_materials": _report(listings.list_materials),
        "list_sorting_centres": _report(listings.list_sorting_centres),
        "list_recycling_centres": _report(listings.list_recycling_centres),
        "list_carriers": _report(listings.list_carriers),
        "join_inner_single_key": _report(relational.join_inner_single_key),
        "join_inner_composite2": _report(relational.join_inner_composite2),
        "join_inner_composite4": _report(relational.join_inner_composite4),
        "join_left_outer": _report(relational.join_left_outer),
        "not_exists_one_level": _report(relational.not_exists_one_level),
        "subtype_semi_filter": _report(relational.subtype_semi_filter),
        "sum_by_three_keys": _report(relational.sum_by_three_keys),
        "avg_of_group_sums": _report(relational.avg_of_group_sums),
        "distinct_points": _report(relational.distinct_points),
        "transit_days": _report(relational.transit_days_by_transport),
        "option_labels": _report(listings.option_labels),
        "result_count": result_count,
        "check_not_null": _checked(quality.check_not_null),
        "check_length": _checked(quality.check_length),
        "check_primary_key": _checked(quality.check_primary_key),
        "check_unique": _checked(quality.check_unique),
        "check_foreign_key": _checked(quality.check_foreign_key),
        "cascade_delete": cascade_delete,
        "set_null_on_delete": set_null_on_delete,
        "restrict_delete": restrict_delete,
        "transport_unified": _report(quality.transport_unified),
        "normalize_state": normalize_state_query,
        "missing_fields": missing_fields_query,
        "ingest_points": ingest_points_query,
        "ingested_points": ingested_points,
        "ingest_lots": ingest_lots_query,
        "ingest_lot_devices": ingest_lot_devices_query,
        "ingested_lot_devices": ingested_lot_devices,
        "full_reload_report": full_reload_report,
        "ingest_stream": ingest_stream,
    }
