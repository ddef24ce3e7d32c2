"""Spelling variant grouping by dense prefix-suffix tiling.

1. *Words.* Maximal runs of Latin letters of whole texts, A-Z lower-cased, are
   counted per task in a bounded table and then over all documents. Where
   ``DAMAGE`` divides the crc32 of ``<doc_id>:<run>``, one code point is deleted
   first (the contract's planted misspellings).
2. *Tiles.* Two words are near if they differ by one inserted, deleted or replaced
   code point: with m the longer length, common prefix p and common suffix s, exactly
   if p + s >= m - 1. Then p >= ceil((m - 1) / 2) or s > floor((m - 1) / 2). So
   each word joins four tiles, (m, prefix) and (m, suffix) for m its length and
   one more, and near words always meet in one. A pair found by its prefix is not
   reported by its suffix again.
3. *Block pairs.* A tile of more than ``BLOCK`` words (fewer if they are long) is cut into
   blocks by the word's hash, and every pair of blocks is a unit of work of
   its own: a hot prefix spreads over many tasks, and no task holds more than two blocks.
4. *Matrices.* A unit's words become matrices of code points, padded to m, aligned left and
   right. All pairs of a pair of rows blocks are compared column by column, from both ends,
   as long as any pair still agrees. Only sums leave a unit: per word the
   number of near words and the best of them.
5. *Roots.* A form has at least five times the count of its word, so forms are a forest
   of a depth logarithmic in the counts: pointer jumping doubles the step each round.

The comparison is quadratic within a tile, and a tile's share of the vocabulary
stays the same as the vocabulary grows: that is the dealt method's price. It is paid in
bytes of a matrix, and spread by blocks.

Defined results: null or empty texts have no words; a null doc_id counts as an empty string in
the crc32; a run of any length is one word (code points, never bytes). Repeated rows count as often as they
stand there. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revtrace.llm.common import arrow_rows, materialize, text_of
from revtrace.session import discard

#: Fixed values of the contract.
DAMAGE = 199
LETTERS = 6
OCCURRENCES = 5
FORM = 5
#: Words of a tile compared in one unit of work, and code points of one block.
BLOCK = 4096
CELLS = 1 << 22
#: Rows of a matrix compared at once.
STEP = 512
#: Words a task counts before it passes them on.
TABLE = 200_000

_RUN = "[A-Za-zÀ-ÿ]{%d,}"
_FOLD = {c: c + 32 for c in range(0x41, 0x5B)}


def _folded(run: str) -> str:
    return run.lower() if run.isascii() else run.translate(_FOLD)


def text_words(doc: str, text: str, letters: int = LETTERS) -> Counter:
    """The words of one text, damaged ones after their damage, with their counts."""
    out: Counter = Counter()
    if not text:
        return out
    start = zlib.crc32(f"{doc}:".encode())
    # A shorter run is shorter still after its damage: it is no word.
    for run, n in Counter(re.findall(_RUN % letters, text)).items():
        word = _folded(run)
        h = zlib.crc32(word.encode(), start)
        if h % DAMAGE == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < letters:
                continue
        out[word] += n
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table: Counter = Counter()

    def batch_of(table: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(table), pa.string()), pa.array(list(table.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column(0), batch.column(1), strict=True):
            table.update(text_words(doc.as_py(), text.as_py()))
            if len(table) > TABLE:
                yield batch_of(table)
                table.clear()
    if table:
        yield batch_of(table)


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", occurrences: int = OCCURRENCES) -> DataFrame:
    """(word, n): the words that occur often enough."""
    arrow_rows(df.sparkSession)
    rows = df.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_id"), text_of(text_col).alias("_text"))
    counts = rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return materialize(counts.where(F.col("n") >= occurrences), "spelling-words")


def _ahead(m):
    """Code points that a prefix tile shares; a suffix tile shares floor((m - 1) / 2) + 1."""
    return F.floor(m / 2)  # ceil((m - 1) / 2)


def tiles(words: DataFrame) -> DataFrame:
    """(_m, _side, _key, word, n, _i, _j): each word once per unit of work, in tiles that can hold a pair."""
    size = F.length("word")
    m, behind = F.col("_m"), F.floor((F.col("_m") - 1) / 2) + 1
    rows = words.select("word", "n", F.explode(F.array(size, size + 1)).alias("_m"))
    rows = rows.select("word", "n", "_m", F.explode(F.array(F.lit(0), F.lit(1))).alias("_side"))
    prefix = F.expr("substring(word, 1, cast(floor(_m / 2) as int))")
    suffix = F.expr("right(word, cast(floor((_m - 1) / 2) + 1 as int))")
    rows = rows.where(F.when(F.col("_side") == 0, _ahead(m)).otherwise(behind) <= size)
    # A digest keeps the keys of very long words short; equal keys stay equal.
    rows = rows.withColumn("_key", F.md5(F.when(F.col("_side") == 0, prefix).otherwise(suffix)))
    key = ["_m", "_side", "_key"]
    full = F.max(F.length("word") == F.col("_m")).alias("_full")
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_size"), full).where("_size > 1 AND _full")
    room = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(F.lit(CELLS) / m)))
    groups = groups.select(*key, F.ceil(F.col("_size") / room).cast("int").alias("_blocks"))
    rows = rows.join(groups, key).withColumn("_own", F.pmod(F.xxhash64("word"), F.col("_blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_other")
    rows = rows.select(*key, "word", "n", "_own", others)
    return rows.select(*key, "word", "n", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "_own")


def _matrix(words: list[bytes], m: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, padded to m and aligned left, and the same aligned right and read backwards."""
    left = np.frombuffer(b"".join(w.ljust(m, b"\0") for w in words), np.uint8).reshape(len(words), m)
    right = np.frombuffer(b"".join(w.rjust(m, b"\0") for w in words), np.uint8).reshape(len(words), m)
    return left, right[:, ::-1]


def _agreement(a: np.ndarray, b: np.ndarray, alive: np.ndarray, limit: int) -> np.ndarray:
    """How many leading columns agree for each pair of rows, up to ``limit``, among the pairs alive."""
    total = np.zeros(alive.shape, np.int32)
    alive = alive.copy()
    for k in range(limit):
        alive &= a[:, k, None] == b[None, :, k]
        if not alive.any():
            break
        total += alive
    return total


def near_pairs(words: list[bytes], m: int, side: int, tile: np.ndarray, own: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the near pairs of one length m and side; rows are sorted by ``tile``, a number per unit of work.

    A unit of two different blocks compares one with the other; words of one block meet in the unit i = j.
    """
    left, right = _matrix(words, m)
    size = np.array([len(w) for w in words])
    across = i != j
    first, second = [], []
    share = m // 2
    for a in range(0, len(words), STEP):
        rows = slice(a, a + STEP)
        for b in range(a, len(words), STEP):
            if tile[b] > tile[min(a + STEP, len(words)) - 1]:
                break
            cols = slice(b, b + STEP)
            alive = tile[rows, None] == tile[None, cols]
            alive &= (size[rows, None] == m) | (size[None, cols] == m)
            alive &= ~across[rows, None] | (own[rows, None] != own[None, cols])
            if a == b:
                alive &= np.triu(np.ones(alive.shape, bool), 1)
            if not alive.any():
                continue
            back = _agreement(right[rows], right[cols], alive, m)
            if side == 0:
                # the shared prefix is given: a pair needs m - 1 - share from the back at most
                alive &= back + m >= m - 1
                front = _agreement(left[rows], left[cols], alive, m)
            else:
                front = _agreement(left[rows], left[cols], alive, share)
                alive &= front < share
            x, y = np.nonzero(alive & (front + back >= m - 1))
            first.append(x + a)
            second.append(y + b)
    none = np.empty(0, np.int64)
    return (np.concatenate(first), np.concatenate(second)) if first else (none, none)


def _best(words: list[str], n: np.ndarray, x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    """Per word of a pair the number of near words and the most frequent, ties by code point."""
    here, there = np.concatenate((x, y)), np.concatenate((y, x))
    used, at = np.unique(there, return_inverse=True)
    rank = np.argsort(np.argsort(np.array([words[k] for k in used.tolist()], object)))
    order = np.lexsort((rank[at], -n[there], here))
    here, there = here[order], there[order]
    start = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
    count = np.diff(np.append(start, len(here)))
    name = lambda rows: pa.array([words[k] for k in rows.tolist()], pa.string())
    return pa.RecordBatch.from_arrays([name(here[start]), pa.array(count), pa.array(n[there[start]]), name(there[start])], ["word", "n_near", "_n", "_form"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit of work; as many whole units as fit ``CELLS`` are compared at once."""

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        m, side, own, i, j, n = (table[c].to_numpy() for c in ("_m", "_side", "_own", "_i", "_j", "n"))
        key = table["_key"].combine_chunks().dictionary_encode().indices.to_numpy()
        fields = np.stack([m, side, key, i, j]).astype(np.int64)
        tile = np.concatenate(([0], np.cumsum((fields[:, 1:] != fields[:, :-1]).any(0))))
        cuts = np.flatnonzero((m[1:] != m[:-1]) | (side[1:] != side[:-1])) + 1
        words = table["word"].to_pylist()
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(words)], strict=True):
            part, at = words[a:b], slice(a, b)
            x, y = near_pairs([w.encode("latin-1") for w in part], int(m[a]), int(side[a]), tile[at], own[at], i[at], j[at])
            if len(x):
                yield _best(part, n[at], x, y)

    held: list[pa.RecordBatch] = []
    cells = 0
    for batch in batches:
        held.append(batch)
        cells += int(batch.column(0).to_numpy().sum())
        if cells >= 2 * CELLS:
            table = pa.Table.from_batches(held)
            last = np.ones(len(table), bool)
            for c in ("_m", "_side", "_key", "_i", "_j"):
                last &= np.asarray(table[c].to_pylist(), object) == table[c][-1].as_py()
            cut = int(np.argmax(last))  # the last unit may go on
            if cut:
                yield from run(table.slice(0, cut).combine_chunks())
                table = table.slice(cut).combine_chunks()
            held = table.to_batches()
            cells = int(table["_m"].to_numpy().sum())
    if held:
        yield from run(pa.Table.from_batches(held).combine_chunks())


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): of every word with near words their number and the most frequent one."""
    unit = ["_m", "_side", "_key", "_i", "_j"]
    rows = tiles(words).repartition(*unit).sortWithinPartitions(*unit)
    found = rows.select(*unit, "_own", "word", "n").mapInArrow(_compare, "word string, n_near long, _n long, _form string")
    best = F.min(F.struct((-F.col("_n")).alias("less"), F.col("_form").alias("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select("word", "n_near", F.col("_b.form").alias("form"), (-F.col("_b.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last form of each word, by pointer jumping."""
    now = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("_moved")), "spelling-roots")
    while not now.where("_moved").isEmpty():
        step = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        further = now.join(step, F.col("root") == F.col("_at"), "left")
        further = further.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        old, now = now, materialize(further, "spelling-roots")
        discard(old)
    return now.select("word", "root")


def group_variants(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", occurrences: int = OCCURRENCES, form_factor: int = FORM
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root."""
    words = vocabulary(df, id_col, text_col, occurrences)
    rows = words.join(near_words(words), "word", "left")
    enough = F.col("form_n") >= form_factor * F.col("n")
    rows = rows.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"),
    )
    rows = materialize(rows, "spelling-near")
    last = roots(rows.where("form IS NOT NULL"))
    return rows.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))


ORACLE_SQL = r"""
WITH RECURSIVE
-- the crc32 table: eight shifts of each byte
bytes(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bytes WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM bytes WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
         translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL),
coded AS (
  SELECT *, flatten(list_transform(string_split(doc || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)) AS b
  FROM counted),
hashed AS (
  SELECT run, k, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), CAST(b AS BIGINT[])),
      lambda c, x: xor(c // 256, t[1 + xor(c % 256, x)]))) AS h
  FROM coded, crc),
damaged AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, k
  FROM hashed),
vocabulary AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM damaged WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
cuts AS (SELECT word, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
         FROM (SELECT word, unnest(range(1, length(word) + 1)) AS p FROM vocabulary)),
near AS (
  SELECT a.word AS a, b.word AS b FROM cuts a JOIN cuts b USING (p, rest) WHERE a.word <> b.word
  UNION SELECT a.word, a.rest FROM cuts a JOIN vocabulary b ON b.word = a.rest
  UNION SELECT a.rest, a.word FROM cuts a JOIN vocabulary b ON b.word = a.rest),
best AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS top, max(n) AS top_n
  FROM near JOIN vocabulary v ON v.word = b GROUP BY a),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 5 * v.n THEN top END AS form,
         CASE WHEN top_n >= 5 * v.n THEN top_n END AS form_n
  FROM vocabulary v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS last, form AS next FROM formed
  UNION ALL
  SELECT w.word, f.word, f.form FROM walk w JOIN formed f ON f.word = w.next)
SELECT f.word, n, n_near, form, form_n, w.last AS root FROM formed f JOIN walk w ON w.word = f.word AND w.next IS NULL
"""
