"""Secret scan with multipart credential linking.

*Base spans* are reported wherever they stand: ``assign`` (a password, token or
key with a value of six characters or more), ``access`` (AKIA identifiers of 20
or more), ``hex`` (runs of 24 or more).

*Weak candidates* mean nothing alone: shorter values, identifiers and
hexadecimal runs, user or client names, and endpoints (URLs, hosts). All parts have a
role (identifier, secret or endpoint) and are joined by interval: a weak
candidate is reported only if its complement starts within ``SCOPE`` code
points. Identifiers and secrets complement each other; an endpoint needs both.
Base spans take part as complements.

The interval join cuts positions into cells of ``SCOPE`` code points and keeps,
for each document, cell and role, only the first and the last start. A
candidate meets its own cell and the two beside it, which is enough to know
exactly whether a complement is in scope, at no more than three rows a candidate. No
pairs are made, however many parts a document has.

Only DataFrame functions run; texts are scanned once and only parts are
shuffled, and only those of documents with both an identifier and a secret.

Positions are code points, ends exclusive. Defined results: a null text counts
as empty. Rows repeating id and text get equal rows. An empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrace.llm.common import keyed, materialize

SCOPE = 200
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
#: Maximal runs; 24 characters or more are base spans, 16 to 23 weak candidates.
HEX = r"[0-9a-f]{16,}"
NAME = r"""(?i)(user_?name|login|client_?id|key_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
ENDPOINT = r"https?://[A-Za-z0-9.-]+(:[0-9]+)?"

#: Order of spans that start together; base kinds first.
KINDS = ["assign", "access", "hex", "weak_assign", "weak_access", "weak_hex", "name", "endpoint"]
ROLES = {
    "assign": "secret", "hex": "secret", "weak_assign": "secret", "weak_hex": "secret",
    "access": "ident", "weak_access": "ident", "name": "ident", "endpoint": "endpoint",
}
_SPAN = "array<struct<start:int,kind:int,end:int>>"


#: Documents with more matches of a pattern than this are folded row by row, not inside one array.
FEW = 256


def _pieces(text: Column, found: Column, pattern: str) -> Column:
    """Lengths of what stands before each match. A text is its pieces between matches and the matches, in turn."""
    return F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda p: F.length(p))


def located(text: Column, found: Column, pattern: str) -> Column:
    """Matches with their places, for a few matches: appending to an array copies it."""
    both = F.arrays_zip(_pieces(text, found, pattern).alias("piece"), found.alias("match"))
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["piece"]
        end = begin + F.length(x["match"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(both, start, step)["out"]).otherwise(none)


#: Pattern, column, kind of a match that holds, kind of one that does not, and what holds; in the order of the columns.
_LONG = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6
_ANY = lambda m: F.lit(True)
SCANS = [
    (ASSIGN, "_a", "assign", "weak_assign", _LONG),
    (ACCESS, "_k", "access", "weak_access", lambda m: F.length(m) >= 20),
    (HEX, "_x", "hex", "weak_hex", lambda m: F.length(m) >= 24),
    (NAME, "_n", "name", None, _ANY),
    (ENDPOINT, "_e", "endpoint", None, _ANY),
]


def _kind(match: Column, strong: str, weak: str | None, holds) -> Column:
    """The number of a match's kind, -1 for none."""
    low = F.lit(KINDS.index(weak) if weak else -1)
    return F.when(holds(match), KINDS.index(strong)).otherwise(low)


def _of(spans: Column, strong: str, weak: str | None, holds) -> Column:
    """Spans as (start, kind, end); those failing ``holds`` are weak, or dropped without a weak kind."""
    kind = lambda s: _kind(s["match"], strong, weak, holds)
    all_ = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), kind(s).alias("kind"), s["end"].alias("end")))
    return F.filter(all_, lambda s: s["kind"] >= 0)


def parts(docs: DataFrame) -> DataFrame:
    """(_id, _h, _parts): all spans and weak candidates of every document; no row is left out.

    A document's places are folded in one pass over its matches. With more than ``FEW`` matches of a
    pattern, each match becomes a row and places are running sums over the rows of the
    document: linear in the matches, where an array that grows match by match is not.
    """
    text = F.col("_text")
    found = docs.select("_id", "_h", "_text", *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(c) for p, c, *_ in SCANS[:4]])
    # Endpoints only matter beside an identifier and a secret.
    both = ((F.size("_k") > 0) | (F.size("_n") > 0)) & ((F.size("_a") > 0) | (F.size("_x") > 0))
    found = found.withColumn("_e", F.when(both, F.regexp_extract_all(text, F.lit(ENDPOINT), F.lit(0))).otherwise(F.array().cast("array<string>")))
    few = F.greatest(*[F.size(c) for _, c, *_ in SCANS]) <= FEW
    spans = F.concat(*[_of(located(text, F.col(c), p), strong, weak, holds) for p, c, strong, weak, holds in SCANS]).cast(_SPAN)
    raw = F.array(*[F.arrays_zip(_pieces(text, F.col(c), p).alias("piece"), F.col(c).alias("match")) for p, c, *_ in SCANS])
    found = found.select("_id", "_h", F.when(few, F.array_sort(spans)).alias("_parts"), F.when(~few, raw).alias("_raw"))
    found = materialize(found, "secrets-parts")
    many = found.where("_raw IS NOT NULL")
    if many.isEmpty():
        return found.drop("_raw")
    return found.where("_raw IS NULL").drop("_raw").unionByName(materialize(_by_rows(many), "secrets-many"))


def _by_rows(many: DataFrame) -> DataFrame:
    """(_id, _h, _parts) from the pieces and matches of documents with many of them."""
    one = many.groupBy("_id", "_h").agg(F.first("_raw").alias("_raw"))
    rows = one.select("_id", "_h", F.posexplode("_raw").alias("_scan", "_all")).select("_id", "_h", "_scan", F.posexplode("_all").alias("_at", "_m"))
    match = F.col("_m.match")
    so_far = Window.partitionBy("_id", "_h", "_scan").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_end", F.sum(F.col("_m.piece") + F.length(match)).over(so_far).cast("int"))
    kind = F.lit(-1)
    for k, (_, _, strong, weak, holds) in enumerate(SCANS):
        kind = F.when(F.col("_scan") == k, _kind(match, strong, weak, holds)).otherwise(kind)
    span = F.struct((F.col("_end") - F.length(match)).alias("start"), kind.alias("kind"), F.col("_end").alias("end"))
    spans = rows.select("_id", "_h", span.alias("_s")).where("_s.kind >= 0").groupBy("_id", "_h").agg(F.collect_list("_s").alias("_found"))
    spans = spans.select(F.col("_id").alias("_sid"), F.col("_h").alias("_sh"), F.array_sort(F.col("_found").cast(_SPAN)).alias("_found"))
    all_ = many.select("_id", "_h").join(spans, F.col("_id").eqNullSafe(F.col("_sid")) & (F.col("_h") == F.col("_sh")), "left")
    return all_.select("_id", "_h", F.coalesce("_found", F.array().cast(_SPAN)).alias("_parts"))


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(ROLES[k]) for k in KINDS]), kind + 1)


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(_lid, _lh, _linked): the weak candidates of each document whose complements are in scope."""
    weak_from = KINDS.index("weak_assign")
    mixed = F.exists("_parts", lambda s: _role(s["kind"]) == "ident") & F.exists("_parts", lambda s: _role(s["kind"]) == "secret")
    weak = F.exists("_parts", lambda s: s["kind"] >= weak_from)
    one = found.where(mixed & weak).groupBy("_id", "_h").agg(F.first("_parts").alias("_parts"))
    rows = one.select("_id", "_h", F.explode("_parts").alias("_s"))
    rows = rows.select("_id", "_h", "_s", _role(F.col("_s.kind")).alias("_role"), F.floor(F.col("_s.start") / scope).alias("_cell"))
    cells = rows.groupBy("_id", "_h", "_cell", "_role").agg(F.min("_s.start").alias("_min"), F.max("_s.start").alias("_max"))
    cells = cells.select(F.col("_id").alias("_cid"), F.col("_h").alias("_ch"), F.col("_cell").alias("_beside"), F.col("_role").alias("_other"), "_min", "_max")
    asks = rows.where(F.col("_s.kind") >= weak_from).withColumn("_beside", F.explode(F.array(*[F.col("_cell") + d for d in (-1, 0, 1)])))
    met = asks.join(cells, F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_h") == F.col("_ch")) & (asks["_beside"] == cells["_beside"]))
    near = (
        (cells["_beside"] == F.col("_cell"))
        | ((cells["_beside"] < F.col("_cell")) & (F.col("_s.start") - F.col("_max") <= scope))
        | ((cells["_beside"] > F.col("_cell")) & (F.col("_min") - F.col("_s.start") <= scope))
    )
    has = met.where(near).groupBy("_id", "_h", "_s", "_role").agg(
        F.max(F.col("_other") == "ident").alias("_ident"), F.max(F.col("_other") == "secret").alias("_secret")
    )
    complete = F.when(F.col("_role") == "ident", F.col("_secret")).when(F.col("_role") == "secret", F.col("_ident")).otherwise(F.col("_ident") & F.col("_secret"))
    return has.where(complete).groupBy(F.col("_id").alias("_lid"), F.col("_h").alias("_lh")).agg(F.collect_list("_s").alias("_linked"))


def _listed(spans: Column) -> Column:
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, n_linked, base_sha256, spans."""
    found = parts(keyed(df, id_col, text_col))
    more = linked(found, scope)
    rows = found.join(more, F.col("_id").eqNullSafe(F.col("_lid")) & (F.col("_h") == F.col("_lh")), "left")
    weak_from = KINDS.index("weak_assign")
    rows = rows.select(
        "_id",
        F.filter("_parts", lambda s: s["kind"] < weak_from).alias("_base"),
        F.coalesce("_linked", F.array().cast(_SPAN)).alias("_linked"),
    )
    count = lambda kind: F.size(F.filter("_base", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return rows.select(
        F.col("_id").alias(id_col),
        *[count(k) for k in KINDS[:3]],
        F.size("_linked").cast("long").alias("n_linked"),
        F.sha2(_listed(F.col("_base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("_base", "_linked"))).alias("spans"),
    )


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    long_value = f"length(regexp_extract(x, {quote(ASSIGN)}, 2)) >= 6"
    rules = [
        (ASSIGN, f"CASE WHEN {long_value} THEN 0 ELSE 3 END"),
        (ACCESS, "CASE WHEN length(x) >= 20 THEN 1 ELSE 4 END"),
        (HEX, "CASE WHEN length(x) >= 24 THEN 2 ELSE 5 END"),
        (NAME, "6"),
        (ENDPOINT, "7"),
    ]
    matches = " UNION ALL ".join(
        f"SELECT r, unnest(m) AS x, unnest(list_transform(range(1, len(m) + 1), lambda i: "
        f"list_sum(list_transform(p[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i-1], lambda y: length(y))), 0))) AS s, "
        f"'{n}' AS pat FROM (SELECT r, regexp_extract_all(t, {quote(p)}) AS m, string_split_regex(t, {quote(p)}) AS p FROM d)"
        for n, (p, _) in enumerate(rules)
    )
    kinds = "CASE pat " + " ".join(f"WHEN '{n}' THEN {k}" for n, (_, k) in enumerate(rules)) + " END"
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "][k + 1]"
    role = "CASE WHEN k IN (0, 2, 3, 5) THEN 's' WHEN k IN (1, 4, 6) THEN 'i' ELSE 'e' END"
    near = lambda role: f"EXISTS (SELECT 1 FROM q WHERE q.r = p.r AND q.role = '{role}' AND abs(q.s - p.s) <= {SCOPE})"
    text = f"string_agg({names} || ':' || s || ':' || e, ',' ORDER BY s, k, e)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS ({matches}),
p AS (SELECT *, {role} AS role FROM (SELECT r, s::BIGINT AS s, (s + length(x))::BIGINT AS e, {kinds} AS k FROM m)),
q AS (SELECT * FROM p),
kept AS (SELECT * FROM p WHERE k < 3 OR (role = 'i' AND {near('s')}) OR (role = 's' AND {near('i')})
         OR (role = 'e' AND {near('i')} AND {near('s')})),
g AS (SELECT r, count(*) FILTER (k = 0) AS a, count(*) FILTER (k = 1) AS b, count(*) FILTER (k = 2) AS c, count(*) FILTER (k > 2) AS l,
      {text} FILTER (k < 3) AS base, {text} AS spans FROM kept GROUP BY r)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, coalesce(l, 0) AS n_linked,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""


ORACLE_SQL = _sql()
