"""Full reload, validated append and delete of the stored domain, each published whole.

The source job drops the database and reloads every table in one
transaction; any violated constraint rolls the whole load back. Here the
same all-or-nothing rule is: write every table once into a new version
folder (in load order), validate the written copy (one row per table), and
publish only when every count is zero.

An append (:func:`append_rows`) writes and checks only its own rows: a
published version is valid, so a rule can only be broken by a new row, and the
published rows that matter are those holding a key that a new row holds or
refers to. Its report equals that of a full check of the whole.

Publications go through the log of :mod:`revtrace.plans.commits`: readers see
one complete version, and of two writers whose changes bear on each other the
later is refused. Tables a publication does not touch keep their folders.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrace.operators import quality
from revtrace.plans.commits import MARKER as MARKER
from revtrace.plans.commits import CommitConflict, commit, committed_run, new_folder
from revtrace.plans.commits import version as _version
from revtrace.schema import TABLES, children_of, load_levels, load_order
from revtrace.sources.domain import Domain
from revtrace.session import remove, shared_dir
from revtrace.sources.store import read_domain, read_path, table_path, valid_run, write_table

RULES = ("not_null", "too_long", "duplicate_key", "foreign_key")


class ReloadRefused(RuntimeError):
    pass


def stage(d: Domain, staging_root: str | None = None) -> Domain:
    """Write every table once to a staging folder in shared storage and
    return the domain read back from it.

    The constraint aggregates then read stored columnar rows instead of
    re-deriving their inputs, the lineage is cut, and a lost executor
    costs a re-read, not a recomputation of the sources.
    """
    root = staging_root or shared_dir(d.spark, "staging")
    for t in load_order():
        write_table(d[t], root, t)
    return read_domain(d.spark, root)


def _row_checks(d: Mapping[str, DataFrame] | Domain, table: str) -> DataFrame:
    """Rows, NULLs in NOT NULL columns and over-long values: one pass."""
    t = TABLES[table]
    nn = [F.col(c.name).isNull() for c in t.columns if not c.nullable]
    ln = [
        quality.length_violation(c.name, c.length)
        for c in t.columns
        if c.length is not None
    ]

    def total(flags):
        if not flags:
            return F.lit(0).cast("long")
        return reduce(lambda a, b: a + b, [F.count_if(f) for f in flags])

    return d[table].agg(
        F.count(F.lit(1)).alias("rows"),
        total(nn).cast("long").alias("not_null"),
        total(ln).cast("long").alias("too_long"),
    ).select(F.lit(table).alias("table_name"), "rows", "not_null", "too_long")


def reload_report(d: Domain, staged: bool = True) -> DataFrame:
    """(table_name, load_order, level, rows, not_null, too_long,
    duplicate_key, foreign_key, publishable) per table."""
    spark = d.spark
    if staged:
        # the sixteen rows are computed here, then the staged copies go
        root = shared_dir(spark, "staging")
        report = reload_report(stage(d, root), staged=False)
        rows = report.collect()
        remove(spark, root)
        return spark.createDataFrame(rows, report.schema)
    row_level = reduce(
        lambda a, b: a.unionByName(b), [_row_checks(d, t) for t in TABLES]
    )
    unique = quality.check_unique(d).select(
        "table_name", F.lit("duplicate_key").alias("rule"), "violations"
    )
    keyed = quality.check_keys(d).drop("constraint_name").unionByName(unique)
    return _report(row_level, keyed)


def _report(row_level: DataFrame, keyed: DataFrame) -> DataFrame:
    """The report from (table_name, rows, not_null, too_long) and (table_name, rule, violations)."""
    levels = load_levels()
    meta = row_level.sparkSession.createDataFrame(
        [(t, i + 1, levels[t]) for i, t in enumerate(load_order())],
        "table_name string, load_order int, level int",
    )
    per_rule = keyed.groupBy("table_name").pivot(
        "rule", ["duplicate_key", "foreign_key"]
    ).agg(F.sum("violations"))
    clean = reduce(
        lambda a, b: a & b, [F.coalesce(F.col(r), F.lit(0)) == 0 for r in RULES]
    )
    # one row per table
    return (
        meta.join(row_level, "table_name")
        .join(per_rule, "table_name", "left")
        .select(
            "table_name",
            "load_order",
            "level",
            "rows",
            *[F.coalesce(F.col(r), F.lit(0)).cast("long").alias(r) for r in RULES],
            clean.alias("publishable"),
        )
        .orderBy("load_order")
    )


def published_folders(spark, target_root: str) -> tuple[int, dict[str, frozenset[str]]]:
    """Number of the last publication (0: none) and the folders of each table."""
    last = _version(spark, target_root)
    return last.number, last.folders


def _refuse(rows: list) -> None:
    bad = [r for r in rows if not r.publishable]
    if bad:
        raise ReloadRefused(
            "; ".join(
                f"{r.table_name}: "
                + ", ".join(f"{k}={getattr(r, k)}" for k in RULES if getattr(r, k))
                for r in bad
            )
        )


def full_reload(d: Domain, target_root: str) -> DataFrame:
    """Validate all tables, then publish them as the new current version.

    Every table is written once, into a folder of its own, and validated
    there. Only if every count is zero is the version published. A refused load
    raises :class:`ReloadRefused`, one that another publication overtook
    :class:`CommitConflict`, and its folder is removed. The report has one row
    per table: it is collected once, and the returned frame holds those rows.
    """
    spark = d.spark
    base = _version(spark, target_root)
    root = new_folder(target_root)
    try:
        report = reload_report(stage(d, root), staged=False)
        rows = report.collect()
        _refuse(rows)
        commit(spark, target_root, base, replace={t: table_path(root, t) for t in load_order()})
    except (ReloadRefused, CommitConflict):
        remove(spark, root)
        raise
    return spark.createDataFrame(rows, report.schema)


def _with_keys_of(stored: DataFrame, new: DataFrame, cols: list[str]) -> DataFrame:
    """The key columns of new rows and of the stored rows that share such a key."""
    wanted = new.select(*cols).dropna().distinct()
    return stored.select(*cols).join(wanted, cols, "left_semi").unionByName(new.select(*cols))


def append_report(d: Domain, additions: Mapping[str, DataFrame]) -> DataFrame:
    """The reload report of ``d`` with ``additions``, for a valid ``d``, from the new rows.

    Stored tables are read for their row counts (file footers), for the keys
    that new rows hold, and for the parent keys they refer to: key columns only, reduced
    by a semi-join before anything is grouped. A new row may refer to a new parent.
    If ``d`` is not valid, the rows of its own that break a rule count only
    where a new row shares their key.
    """
    row_level, keyed = [], []

    def rule(df: DataFrame, name: str) -> DataFrame:
        return df.select("table_name", F.lit(name).alias("rule"), "violations")

    for t in load_order():
        zero = [F.lit(0).cast("long").alias(c) for c in ("not_null", "too_long")]
        stored = d[t].agg(F.count(F.lit(1)).alias("rows"))
        row_level.append(stored.select(F.lit(t).alias("table_name"), "rows", *zero))
        if t not in additions:
            continue
        new, table = additions[t], TABLES[t]
        row_level.append(_row_checks(additions, t))
        keys = [(table.pk_name, table.primary_key, True), *[(u.name, u.columns, False) for u in table.uniques]]
        for name, cols, nulls in keys:
            held = _with_keys_of(d[t], new, list(cols))
            keyed.append(rule(quality.key_duplicates(held, list(cols), t, name, nulls), "duplicate_key"))
        for fk in table.foreign_keys:
            pk = list(fk.parent_columns)
            named = new.select(*[F.col(c).alias(p) for c, p in zip(fk.columns, pk)]).dropna().distinct()
            parent = d[fk.parent].select(*pk).join(named, pk, "left_semi")
            if fk.parent in additions:
                parent = parent.unionByName(additions[fk.parent].select(*pk))
            missed = quality.orphan_counts(new, {fk.parent: parent}, [fk])
            missed = missed.select(F.lit(t).alias("table_name"), F.col(f"`{fk.name}`").alias("violations"))
            keyed.append(rule(missed, "foreign_key"))
    if not keyed:
        keyed = [d.spark.createDataFrame([], "table_name string, rule string, violations long")]
    counted = ("rows", "not_null", "too_long")
    totals = reduce(DataFrame.unionByName, row_level).groupBy("table_name").agg(*[F.sum(c).alias(c) for c in counted])
    return _report(totals, reduce(DataFrame.unionByName, keyed))


def append_rows(additions: Mapping[str, DataFrame], target_root: str, run_id: str) -> DataFrame:
    """Add rows to published tables as run ``run_id``: all of them, or none.

    The rows are written once and validated (:func:`append_report`). A violated
    rule raises :class:`ReloadRefused`. The keys of the new rows must stay free and
    their parents must stay there: if a table that gets rows has changed since,
    or a parent table has lost rows, :class:`CommitConflict` is raised and the run can
    be tried again. A run that has been published is not added again.
    Returns (table_name, affected).
    """
    spark = next(iter(additions.values())).sparkSession
    schema = "table_name string, affected long"
    done = committed_run(spark, target_root, valid_run(run_id))
    if not done:
        d = read_published(spark, target_root)
        root = new_folder(target_root, run_id)
        for t, df in additions.items():
            write_table(df, root, t)
        done = {t: table_path(root, t) for t in additions}
        parents = {fk.parent for t in additions for fk in TABLES[t].foreign_keys}
        try:
            _refuse(append_report(d, {t: read_path(spark, f, t) for t, f in done.items()}).collect())
            base = _version(spark, target_root, d.version)
            commit(spark, target_root, base, add=done, unchanged=additions, may_grow=parents)
        except (ReloadRefused, CommitConflict):
            remove(spark, root)
            raise
    return spark.createDataFrame([(t, read_path(spark, f, t).count()) for t, f in sorted(done.items())], schema)


def publish_delete(plan: quality.DeletePlan, target_root: str) -> dict[str, int]:
    """Apply a delete to the published tables; rows left in each table it touches.

    The plan must come from :func:`read_published` of the same target. Its
    NO ACTION check runs first (:class:`quality.DeleteRefused`); then the new
    contents of the touched tables are written and published together, so
    readers see all effects of the delete or none. If a table it touches, or one
    that refers to a deleted row, has changed since the plan's version,
    :class:`CommitConflict` is raised. Deleting the same rows again
    publishes equal tables.
    """
    spark = plan.domain.spark
    base = _version(spark, target_root, plan.domain.version)
    if not base.number:
        raise ReloadRefused("nothing is published yet")
    root, left, folders = new_folder(target_root), {}, {}
    for table, rows in quality.execute_delete(plan).items():
        write_table(rows, root, table)
        folders[table] = table_path(root, table)
        left[table] = read_path(spark, folders[table], table).count()
    referring = {child for t in plan.doomed for child, _ in children_of(t)}
    try:
        commit(spark, target_root, base, replace=folders, unchanged=referring)
    except CommitConflict:
        remove(spark, root)
        raise
    return left


def read_published(spark, target_root: str, number: int | None = None) -> Domain:
    """The domain as of the last publication, or of an earlier one."""
    v = _version(spark, target_root, number)
    if not v.number:
        raise ReloadRefused("nothing is published yet")
    tables = {t: (lambda t=t, f=f: read_path(spark, sorted(f), t)) for t, f in v.folders.items()}
    return Domain(spark, tables, v.number)
