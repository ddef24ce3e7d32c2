"""Source divergence audit with duplicate-text collapse.

1. *Collapse.* Identical texts of a language (equal SHA-256) are counted per source, without moving the
   texts; the text itself is shuffled once per language and digest, copies
   within a task before. So every distinct text is tokenised once, with the
   list of its sources and multiplicities beside it: at most one entry per source of the
   language, however many copies there are.
2. *Counts.* Per task a bounded table adds, for every (lang, source, term),
   occurrences and document frequency, both weighted by the multiplicities.
   A language keeps the terms of at least ``DOCUMENTS`` of its documents.
3. *Sparse pairs.* For sources g and h, a = p of g, b = p of h, a0 and b0 those of
   an absent term: sum |a - b| over all V kept terms is V |a0 - b0|, plus, over the terms of g,
   |a - b0| - |a0 - b0|, the same for h, plus, over the terms of both,
   |a - b| - |a - b0| - |a0 - b| + |a0 - b0|. Terms of neither are never
   visited. The terms of one source enter as a histogram of counts, those of both by an
   equi-join on the term.

All arithmetic is exact (decimals and 64-bit integers). The result has one row for each ordered
pair of sources of a language, which is what is asked for.

Defined results: null text, lang and source are empty strings. A language without kept terms gives
pairs with value 0 and no terms. Repeated rows count as often as they stand there. An empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revtrace.llm.common import arrow_rows, materialize, text_of

#: Fixed values of the contract.
DOCUMENTS = 30
TOP = 50
SCALE = 1_000_000_000
PRIOR = 5
#: Entries a task counts before it passes them on, and code points tokenised at once.
TABLE = 600_000
PIECE = 1 << 20

_TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_PART = re.compile("[\x00-\x40\x5b-\x60\x7b-\x7f]")
#: Documents and occurrences of a table's entry in one integer.
_DOCUMENT = 1 << 48


def text_terms(text: str) -> Counter:
    """The terms of one text with their counts; a long text is read in pieces cut between terms."""
    out: Counter = Counter()
    text = text.encode().lower().decode()  # bytes: only A-Z change
    at = 0
    while at < len(text):
        end = at + PIECE
        cut = _PART.search(text, end) if end < len(text) else None
        stop = cut.start() if cut else len(text)
        out.update(_TERM.findall(text, at, stop))
        at = stop
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) from (lang, text, sources): sums of one task, passed on when the tables are full."""
    tables: dict[tuple[str, str], dict[str, int]] = {}
    entries = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), table in tables.items():
            docs, n = zip(*[divmod(v, _DOCUMENT) for v in table.values()], strict=True)
            same = [pa.repeat(pa.scalar(c, pa.string()), len(table)) for c in (lang, source)]
            columns = [*same, pa.array(list(table), pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["_lang", "_source", "_term", "_n", "_docs"])

    for batch in batches:
        for lang, text, sources in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            terms = text_terms(text)
            if not terms:
                continue
            for s in sources:
                k = s["_k"]
                table = tables.setdefault((lang, s["_source"]), {})
                entries -= len(table)
                get, once = table.get, k * _DOCUMENT
                for term, n in terms.items():
                    table[term] = get(term, 0) + once + n * k
                entries += len(table)
                if entries >= TABLE:
                    yield from rows()
                    tables.clear()
                    entries = 0
    yield from rows()


def distinct_texts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_lang, _text, _sources) of each distinct text, and all groups (_lang, _source)."""
    marked = rows.withColumn("_digest", F.unhex(F.sha2("_text", 256)))
    copies = materialize(marked.groupBy("_lang", "_digest", "_source").agg(F.count(F.lit(1)).alias("_k")), "divergence-copies")
    sources = copies.groupBy("_lang", "_digest").agg(F.collect_list(F.struct("_source", "_k")).alias("_sources"))
    texts = marked.groupBy("_lang", "_digest").agg(F.any_value("_text").alias("_text"))
    groups = copies.select("_lang", "_source").distinct()
    return texts.join(sources, ["_lang", "_digest"]).select("_lang", "_text", "_sources"), groups


def term_counts(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(_lang, _source, _term, _n, _docs), and all groups (_lang, _source)."""
    arrow_rows(df.sparkSession)
    rows = df.select(text_of(lang_col).alias("_lang"), text_of(source_col).alias("_source"), text_of(text_col).alias("_text"))
    texts, groups = distinct_texts(rows)
    schema = "_lang string, _source string, _term string, _n long, _docs long"
    counts = texts.mapInArrow(_count, schema).groupBy("_lang", "_source", "_term").agg(F.sum("_n").alias("_n"), F.sum("_docs").alias("_docs"))
    return materialize(counts, "divergence-counts"), groups


def _p(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exactly; null without terms."""
    up = (count + PRIOR).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")
    down = (total + PRIOR * terms).cast("decimal(28,0)")
    return 1 + F.call_function("div", up, F.when(down > 0, down))


def audit(
    df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", documents: int = DOCUMENTS, top: int = TOP
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): ``pair`` against the other sources, ``term`` above the language."""
    counts, groups = term_counts(df, lang_col, source_col, text_col)
    kept = counts.groupBy("_lang", "_term").agg(F.sum("_n").alias("_all"), F.sum("_docs").alias("_docs")).where(F.col("_docs") >= documents)
    kept = materialize(kept.drop("_docs"), "divergence-terms")
    langs = kept.groupBy("_lang").agg(F.count(F.lit(1)).alias("_v"), F.sum("_all").alias("_total"))
    cells = materialize(counts.drop("_docs").join(kept, ["_lang", "_term"]), "divergence-cells")
    sizes = cells.groupBy("_lang", "_source").agg(F.sum("_n").alias("_sum"))
    zero = F.lit(0).cast("long")
    groups = groups.join(langs, "_lang", "left").join(sizes, ["_lang", "_source"], "left")
    groups = groups.select("_lang", "_source", F.coalesce("_v", zero).alias("_v"), F.coalesce("_total", zero).alias("_total"), F.coalesce("_sum", zero).alias("_sum"))
    groups = materialize(groups.withColumn("_p0", F.coalesce(_p(F.lit(0), F.col("_sum"), F.col("_v")), zero)), "divergence-groups")

    # p of every present cell, and the language's p of the term
    present = cells.join(groups, ["_lang", "_source"])
    present = present.select("_lang", "_source", "_term", "_n", "_p0", _p(F.col("_n"), F.col("_sum"), F.col("_v")).alias("_p"), _p(F.col("_all"), F.col("_total"), F.col("_v")).alias("_q"))
    present = materialize(present, "divergence-present")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        order = Window.partitionBy("_lang", "_source").orderBy(F.desc("_value"), F.asc("_item"))
        rows = rows.withColumn("_rank", F.row_number().over(order))
        return rows.select("_lang", "_source", F.lit(part).alias("_part"), "_item", "_value", "_rank")

    above = present.where(F.col("_p") > F.col("_q")).select("_lang", "_source", F.col("_term").alias("_item"), (F.col("_p") - F.col("_q")).alias("_value"))
    terms = ranked(above, "term").where(F.col("_rank") <= top)
    pairs = ranked(pair_values(groups, present), "pair")
    out = pairs.unionByName(terms)
    return out.select(*[F.col(f"_{c}").alias(c) for c in ("lang", "source", "part", "item")], F.col("_value").cast("long").alias("value"), F.col("_rank").cast("int").alias("rank"))


def pair_values(groups: DataFrame, present: DataFrame) -> DataFrame:
    """(_lang, _source, _item, _value) for every ordered pair of sources of a language."""
    side = lambda s: groups.select("_lang", F.col("_source").alias(f"_{s}"), F.col("_p0").alias(f"_{s}0"), F.col("_v").alias(f"_v{s}"))
    both = side("g").join(side("h").drop("_vh"), "_lang").where("_g <> _h")
    absent = F.abs(F.col("_g0") - F.col("_h0"))
    # terms of g against h's absent value: by distinct value of p, not by term
    steps = present.groupBy("_lang", F.col("_source").alias("_g"), "_p").agg(F.count(F.lit(1)).alias("_k"))
    one = both.join(steps, ["_lang", "_g"]).groupBy("_lang", "_g", "_h").agg(F.sum(F.col("_k") * (F.abs(F.col("_p") - F.col("_h0")) - absent)).alias("_one"))
    one = materialize(one, "divergence-one")
    # terms of both, each unordered pair once
    cell = lambda s: present.select("_lang", "_term", F.col("_source").alias(f"_{s}"), F.col("_p").alias(f"_{s}p"), F.col("_p0").alias(f"_{s}0"))
    a, b = F.col("_gp"), F.col("_hp")
    meet = F.abs(a - b) - F.abs(a - F.col("_h0")) - F.abs(F.col("_g0") - b) + absent
    common = cell("g").join(cell("h"), ["_lang", "_term"]).where("_g < _h").groupBy("_lang", "_g", "_h").agg(F.sum(meet).alias("_common"))
    common = materialize(common, "divergence-common")
    turned = common.select("_lang", F.col("_h").alias("_g"), F.col("_g").alias("_h"), "_common")
    rows = both.join(one, ["_lang", "_g", "_h"], "left")
    rows = rows.join(one.select("_lang", F.col("_h").alias("_g"), F.col("_g").alias("_h"), F.col("_one").alias("_other")), ["_lang", "_g", "_h"], "left")
    rows = rows.join(common.unionByName(turned), ["_lang", "_g", "_h"], "left")
    zero = F.lit(0).cast("long")
    value = F.col("_vg") * absent + F.coalesce("_one", zero) + F.coalesce("_other", zero) + F.coalesce("_common", zero)
    return rows.select("_lang", F.col("_g").alias("_source"), F.col("_h").alias("_item"), value.alias("_value"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
tokens AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS c FROM tokens GROUP BY ALL HAVING count(DISTINCT r) >= 30),
cells AS (SELECT lang, source, term, count(*) AS c FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
sources AS (SELECT DISTINCT lang, source FROM d),
size AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang),
own AS (SELECT lang, source, sum(c) AS n FROM cells GROUP BY ALL),
dense AS (SELECT s.lang, s.source, k.term, coalesce(c.c, 0) AS c,
                 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(o.n, 0) + 5 * z.v) AS p,
                 1 + (1000000000::HUGEINT * (k.c + 5)) // (z.n + 5 * z.v) AS q
          FROM sources s JOIN kept k USING (lang) JOIN size z USING (lang)
          LEFT JOIN own o ON o.lang = s.lang AND o.source = s.source
          LEFT JOIN cells c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
diff AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
         FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
          FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN diff f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
found AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM dense WHERE c > 0 AND p > q),
placed AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM placed WHERE part = 'pair' OR rank <= 50
"""
