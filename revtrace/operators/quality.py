"""Declared integrity rules as set-based data-quality operators.

The source database enforces its constraints row by row on insert and
delete. Over large tables the same rules become whole-table checks that
return counts of violating rows, and deletes become a plan computed over the
foreign-key graph before anything is written.

All checks are driven by the catalogue in :mod:`revtrace.schema`:

* NOT NULL and length limits: one aggregate pass per table
  (``count_if`` per column), unpivoted to one row per constraint,
* PRIMARY KEY / UNIQUE: ``groupBy(key).count()`` (map-side partial counts,
  so a key holding a large share of rows costs one row per task),
* FOREIGN KEY: one pass per child table: its key columns are left-joined
  to the distinct keys of all parents (broadcast when a key set is
  measured small), and the misses of every key are counted together,
* PRIMARY KEY and FOREIGN KEY of a whole domain: one grouped pass per
  primary key over its rows and all references to it,
* deletes: doomed key sets flow down the FK DAG in topological order
  (``left_semi`` per cascading edge); SET NULL and NO ACTION edges are
  evaluated against the final doomed sets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrace.schema import TABLES, ForeignKey, children_of, load_order
from revtrace.session import materialize
from revtrace.sources.domain import Domain

def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _per_column_counts(
    df: DataFrame, table: str, flags: dict[str, F.Column]
) -> DataFrame:
    """One aggregate pass: ``count_if(flag)`` per constraint, as rows."""
    agg = df.agg(*[F.count_if(c).alias(name) for name, c in flags.items()])
    return agg.unpivot([], list(flags), "constraint_name", "violations").select(
        F.lit(table).alias("table_name"),
        "constraint_name",
        F.col("violations").cast("long").alias("violations"),
    )


def check_not_null(d: Domain, tables: list[str] | None = None) -> DataFrame:
    """NULL count of every NOT NULL column: (table_name, constraint_name, violations)."""
    out = []
    for name in tables or list(TABLES):
        t = TABLES[name]
        flags = {
            f"nn_{name}_{c.name}": F.col(c.name).isNull()
            for c in t.columns
            if not c.nullable
        }
        if flags:
            out.append(_per_column_counts(d[name], name, flags))
    return _union(out)


def length_violation(col: str, limit: int) -> F.Column:
    """Longer than ``limit`` once trailing blanks are dropped.

    Excess trailing spaces are truncated, not rejected, for both CHAR(n)
    and VARCHAR(n), so they never count.
    """
    return F.char_length(F.rtrim(F.col(col))) > limit


def check_length(d: Domain, tables: list[str] | None = None) -> DataFrame:
    """Values longer than their declared CHAR/VARCHAR length."""
    out = []
    for name in tables or list(TABLES):
        t = TABLES[name]
        flags = {
            f"len_{name}_{c.name}": length_violation(c.name, c.length)
            for c in t.columns
            if c.length is not None
        }
        if flags:
            out.append(_per_column_counts(d[name], name, flags))
    return _union(out)


def key_duplicates(
    df: DataFrame, cols: list[str], table: str, constraint: str, nulls_violate: bool
) -> DataFrame:
    """Duplicate groups and surplus rows of a key, in one grouped pass.

    Rows with a NULL in the key are grouped together by ``groupBy`` and
    told apart afterwards: they violate a primary key but are ignored by a
    UNIQUE constraint (NULLs are distinct).
    """
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    grouped = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).select(
        any_null.alias("null_key"), "n"
    )
    dup = ~F.col("null_key") & (F.col("n") > 1)
    null_rows = F.when(F.col("null_key"), F.col("n")).otherwise(F.lit(0))
    surplus = F.when(dup, F.col("n") - 1).otherwise(F.lit(0))
    violating = surplus + null_rows if nulls_violate else surplus
    return grouped.agg(
        F.count_if(dup).alias("duplicate_groups"),
        F.coalesce(F.sum(violating), F.lit(0)).alias("violations"),
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(constraint).alias("constraint_name"),
        F.col("duplicate_groups").cast("long").alias("duplicate_groups"),
        F.col("violations").cast("long").alias("violations"),
    )


def check_primary_key(d: Domain, tables: list[str] | None = None) -> DataFrame:
    """Per primary key: duplicate key groups and violating rows.

    ``violations`` = rows beyond the first in each duplicated key + rows
    with a NULL key column.
    """
    return _union(
        [
            key_duplicates(d[n], list(TABLES[n].primary_key), n, TABLES[n].pk_name, True)
            for n in tables or list(TABLES)
        ]
    )


def check_unique(d: Domain, tables: list[str] | None = None) -> DataFrame:
    """Per UNIQUE constraint: duplicate groups and surplus rows (NULLs ignored)."""
    out = [
        key_duplicates(d[n], list(u.columns), n, u.name, False)
        for n in tables or list(TABLES)
        for u in TABLES[n].uniques
    ]
    return _union(out)


def orphan_counts(child: DataFrame, parents: dict[str, DataFrame], fks: list[ForeignKey]) -> DataFrame:
    """One row with a column per foreign key: child rows whose non-NULL key has no parent.

    The child is scanned once. Parent keys are distinct, so no join repeats a
    child row; a hot child key stands on the left side of a left outer join,
    which adaptive execution can split.
    """
    rows = child.select(*sorted({c for fk in fks for c in fk.columns}))
    misses = []
    for i, fk in enumerate(fks):
        keys = parents[fk.parent].select(
            *[F.col(p).alias(f"_k{i}_{c}") for c, p in zip(fk.columns, fk.parent_columns)]
        )
        keys = keys.distinct().withColumn(f"_hit{i}", F.lit(True))
        same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_k{i}_{c}") for c in fk.columns])
        rows = rows.join(keys, same, "left").drop(*[f"_k{i}_{c}" for c in fk.columns])
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fk.columns])
        misses.append(F.count_if(complete & F.col(f"_hit{i}").isNull()).alias(fk.name))
    return rows.agg(*misses)


def check_foreign_key(d: Domain, tables: list[str] | None = None) -> DataFrame:
    """Orphan rows per foreign key (MATCH SIMPLE: a NULL column skips the row)."""
    out = []
    for name in tables or list(TABLES):
        fks = list(TABLES[name].foreign_keys)
        if not fks:
            continue
        counts = orphan_counts(d[name], {fk.parent: d[fk.parent] for fk in fks}, fks)
        parent = F.create_map(*[F.lit(x) for fk in fks for x in (fk.name, fk.parent)])
        out.append(
            counts.unpivot([], [fk.name for fk in fks], "constraint_name", "violations").select(
                F.lit(name).alias("table_name"),
                "constraint_name",
                parent[F.col("constraint_name")].alias("parent_table"),
                F.col("violations").cast("long").alias("violations"),
            )
        )
    return _union(out)


def check_keys(d: Domain, tables: list[str] | None = None) -> DataFrame:
    """``check_primary_key`` and ``check_foreign_key`` at once: (table_name, constraint_name, rule, violations).

    A primary key is grouped once together with all references to it (every foreign
    key refers to a primary key): per value, the rows that hold it and those of each foreign key that
    refer to it are counted. Partial counts come before the shuffle, so a hot
    key costs one row per task, and no table is sorted or joined.
    """
    out = []
    for name in tables or list(TABLES):
        t = TABLES[name]
        cols = list(t.primary_key)
        rules = [(name, t.pk_name, "duplicate_key")]
        frames = [d[name].select(*cols, F.lit(0).alias("_by"))]
        for child, fk in children_of(name):
            if set(fk.parent_columns) != set(cols):
                raise ValueError(f"{fk.name} does not refer to the primary key of {name}")
            named = [F.col(c).alias(p) for c, p in zip(fk.columns, fk.parent_columns)]
            frames.append(d[child].select(*named).dropna().withColumn("_by", F.lit(len(rules))))
            rules.append((child, fk.name, "foreign_key"))
        any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
        counts = [F.count_if(F.col("_by") == k).alias(f"_n{k}") for k in range(len(rules))]
        groups = _union(frames).groupBy(*cols).agg(*counts)
        held = F.col("_n0")
        wrong = [F.when(any_null, held).otherwise(F.greatest(held - 1, F.lit(0)))]
        wrong += [F.when(held == 0, F.col(f"_n{k}")).otherwise(F.lit(0)) for k in range(1, len(rules))]
        totals = groups.agg(*[F.coalesce(F.sum(w), F.lit(0)).cast("long").alias(f"_v{k}") for k, w in enumerate(wrong)])
        rows = [
            F.struct(*[F.lit(x).alias(c) for c, x in zip(("table_name", "constraint_name", "rule"), rule)], F.col(f"_v{k}").alias("violations"))
            for k, rule in enumerate(rules)
        ]
        out.append(totals.select(F.inline(F.array(*rows))))
    return _union(out)


# ---------------------------------------------------------------- deletes


@dataclass
class DeletePlan:
    """Effects of deleting a set of rows, computed before any write.

    ``doomed``: per table, the primary keys of rows removed (the target
    rows plus everything reached through ON DELETE CASCADE).
    ``nulled``: per (table, fk), primary keys of surviving rows whose FK
    columns become NULL (ON DELETE SET NULL).
    ``blocking``: rows referencing a doomed parent through a NO ACTION key
    and not deleted themselves; non-empty means the delete is refused.
    """

    domain: Domain
    doomed: dict[str, DataFrame]
    nulled: dict[tuple[str, str], DataFrame]
    blocking: DataFrame

    def survivors(self, table: str) -> DataFrame:
        """The table after the delete (SET NULL applied)."""
        t = TABLES[table]
        pk = list(t.primary_key)
        df = self.domain[table]
        if table in self.doomed:
            df = df.join(self.doomed[table], pk, "left_anti")
        for (name, fk_name), keys in self.nulled.items():
            if name != table:
                continue
            fk = next(f for f in t.foreign_keys if f.name == fk_name)
            hit = keys.select(*pk).withColumn("_hit", F.lit(True))
            df = df.join(hit, pk, "left").select(
                *[
                    F.when(F.col("_hit"), F.lit(None).cast(c.spark_type))
                    .otherwise(F.col(c.name))
                    .alias(c.name)
                    if c.name in fk.columns
                    else F.col(c.name)
                    for c in t.columns
                ]
            )
        return df

    def summary(self) -> DataFrame:
        """(table_name, effect, affected_rows) for every table reached."""
        rows = [
            keys.agg(F.count(F.lit(1)).alias("affected_rows")).select(
                F.lit(name).alias("table_name"),
                F.lit("deleted").alias("effect"),
                "affected_rows",
            )
            for name, keys in self.doomed.items()
        ] + [
            keys.agg(F.count(F.lit(1)).alias("affected_rows")).select(
                F.lit(name).alias("table_name"),
                F.lit("set_null").alias("effect"),
                "affected_rows",
            )
            for (name, _), keys in self.nulled.items()
        ]
        return _union(rows)


def _referencing(child: DataFrame, parent_keys: DataFrame, fk: ForeignKey) -> DataFrame:
    """Child rows whose FK points at one of ``parent_keys`` (parent columns)."""
    keys = parent_keys.select(
        *[F.col(p).alias(c) for c, p in zip(fk.columns, fk.parent_columns)]
    ).distinct()
    return child.join(keys, list(fk.columns), "left_semi")


def plan_delete(
    d: Domain, table: str, rows: DataFrame, stage_keys: bool = True
) -> DeletePlan:
    """Plan ``DELETE FROM table`` for ``rows`` (matched on the primary key).

    Tables are visited in topological order, so every parent's doomed set
    is final before its children are examined. Each doomed set is a set of
    primary keys; children are matched with semi-joins on distinct parent
    keys. With ``stage_keys`` every doomed key set is written once to the
    shared checkpoint folder as the walk goes down the FK graph, so a level
    is computed once instead of once per descendant.
    """

    def keep(keys: DataFrame) -> DataFrame:
        return materialize(keys, "delete-keys") if stage_keys else keys

    def referenced(parent: str, fk: ForeignKey) -> DataFrame:
        # doomed parent rows, reduced to the columns the FK references
        ppk = list(TABLES[parent].primary_key)
        if set(fk.parent_columns) <= set(ppk):
            return doomed[parent]
        return d[parent].join(doomed[parent], ppk, "left_semi")

    order = load_order()
    pk = list(TABLES[table].primary_key)
    doomed: dict[str, DataFrame] = {
        table: keep(
            d[table].join(rows.select(*pk).distinct(), pk, "left_semi").select(*pk).distinct()
        )
    }
    for name in order[order.index(table) + 1 :]:
        child_pk = list(TABLES[name].primary_key)
        hits = [
            _referencing(d[name], referenced(fk.parent, fk), fk).select(*child_pk)
            for fk in TABLES[name].foreign_keys
            if fk.on_delete == "cascade" and fk.parent in doomed
        ]
        if hits:
            doomed[name] = keep(_union(hits).distinct())

    nulled: dict[tuple[str, str], DataFrame] = {}
    blocking = []
    for parent in list(doomed):
        for child, fk in children_of(parent):
            if fk.on_delete == "cascade":
                continue
            child_pk = list(TABLES[child].primary_key)
            refs = _referencing(d[child], referenced(parent, fk), fk)
            if child in doomed:
                refs = refs.join(doomed[child], child_pk, "left_anti")
            if fk.on_delete == "set_null":
                nulled[(child, fk.name)] = refs.select(*child_pk)
            else:
                blocking.append(
                    refs.agg(F.count(F.lit(1)).alias("referencing_rows")).select(
                        F.lit(child).alias("table_name"),
                        F.lit(fk.name).alias("constraint_name"),
                        F.lit(parent).alias("parent_table"),
                        "referencing_rows",
                    )
                )
    if blocking:
        blocked = _union(blocking).filter(F.col("referencing_rows") > 0)
    else:
        blocked = d.spark.createDataFrame(
            [],
            "table_name string, constraint_name string, parent_table string, "
            "referencing_rows long",
        )
    return DeletePlan(d, doomed, nulled, blocked)


class DeleteRefused(RuntimeError):
    pass


def execute_delete(plan: DeletePlan) -> dict[str, DataFrame]:
    """New contents of every affected table, or :class:`DeleteRefused`.

    The NO ACTION check runs first (one small job); nothing is produced if
    any referencing row would be left dangling.
    """
    if not plan.blocking.isEmpty():
        rows = plan.blocking.collect()  # at most one row per foreign key
        raise DeleteRefused(
            "; ".join(
                f"{r.constraint_name}: {r.referencing_rows} rows of {r.table_name}"
                for r in rows
            )
        )
    affected = set(plan.doomed) | {t for t, _ in plan.nulled}
    return {t: plan.survivors(t) for t in affected}


# ------------------------------------------------------------- subtype view


def transport_unified(d: Domain) -> DataFrame:
    """Supertype joined to both subtype tables, one row per transport.

    ``leg`` names the subtype that holds the code (``both`` exposes a
    violated disjointness, NULL a transport in neither); ``destino`` is the
    sorting or recycling centre it goes to.
    """
    t = d.transporte.select(
        "cod_rastreio", "transportadora", "data_envio", "data_chegada"
    )
    tct = d.transporte_coleta_tri.select(
        "cod_rastreio", F.col("centro_triagem"), F.lit(True).alias("_leg1")
    )
    ttr = d.transporte_tri_reciclagem.select(
        "cod_rastreio", "centro_reciclagem", "mtr", F.lit(True).alias("_leg2")
    )
    leg1 = F.col("_leg1").isNotNull()
    leg2 = F.col("_leg2").isNotNull()
    return (
        t.join(tct, "cod_rastreio", "left")
        .join(ttr, "cod_rastreio", "left")
        .select(
            "cod_rastreio",
            "transportadora",
            "data_envio",
            "data_chegada",
            F.when(leg1 & leg2, F.lit("both"))
            .when(leg1, F.lit("coleta_triagem"))
            .when(leg2, F.lit("triagem_reciclagem"))
            .alias("leg"),
            F.coalesce(F.col("centro_triagem"), F.col("centro_reciclagem")).alias(
                "destino"
            ),
            "mtr",
        )
    )
