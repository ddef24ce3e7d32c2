"""Substring deduplication: words of passages that stand earlier in the corpus are removed.

A window of ``WINDOW`` words is a repeat if its word sequence also starts earlier:
in a document that comes first, or earlier in the same document. All words
covered by a repeat go; windows are judged on the input.

Documents meet only where they can share a window (``segments``): each shard
gets all segments with its anchors. A shard indexes its different segments
in a compressed FM-index (Burrows-Wheeler transform in a wavelet matrix) and
streams them through it by backward search. For every position the search yields
the matching statistic, clipped to a window: the interval of all places where the window
starts, and from that the earliest place. Intervals of repeated windows go back
to all documents that hold the segment, by a join on its key and content
(one row per segment and run on one side, so a hot passage can be split).

Words are compared as 64-bit hashes. Shards hold about ``SHARD`` bytes of
text, whatever the corpus's size; a document's own intervals are gathered per document.

Defined results: a null text has no words. Documents shorter than a window keep
everything. Documents are ordered by id, nulls first, then by a hash of the text;
rows repeating id and text are one document and get equal rows. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.common import arrow_rows, keyed, materialize
from revtrace.llm.fm_index import FMIndex, shared_prefix
from revtrace.llm.segments import RUN, Finder, Shape, Symbols, shards
from revtrace.llm.words import Piece, hashes, pieces, spans

WINDOW = 20
GRAM = 8
SHARD = 4 << 20


def word_symbols(piece: Piece) -> Symbols:
    starts, ends, first = spans(piece)
    return Symbols(hashes(piece.data, starts, ends), starts, ends, first)


def _index_shard(width: int):
    """Earliest places of the windows of a shard's segments, as runs."""

    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        if not n:
            return
        raw = table["_text"].combine_chunks()
        sizes = np.diff(np.frombuffer(raw.buffers()[1], np.int32, n + 1, raw.offset * 4).astype(np.int64))
        data = np.frombuffer(raw.buffers()[2], np.uint8)
        low = int(np.frombuffer(raw.buffers()[1], np.int32, 1, raw.offset * 4)[0])
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        piece = Piece(0, n, data[low : low + int(offsets[-1])], offsets)
        starts, ends, first = spans(piece)
        _, symbol = np.unique(hashes(piece.data, starts, ends), return_inverse=True)
        # Symbol 0 ends every segment.
        count = np.diff(first)
        segment = np.repeat(np.arange(n), count)
        at = np.arange(len(symbol)) + segment
        text = np.zeros(len(symbol) + n, np.int64)
        text[at] = symbol + 1
        begin = first[:-1] + np.arange(n)
        windows = count - width + 1

        index = FMIndex(text, RUN + width)
        order = index.order
        owner = np.searchsorted(begin, order, "right") - 1
        offset = order - begin[owner]
        rank, place = table["_rank"].to_numpy(), table["_start"].to_numpy()
        # Suffixes with equal windows are neighbours; their earliest place in document order.
        group = np.cumsum(~shared_prefix(text, order, width)) - 1
        by_place = np.lexsort((place[owner] + offset, rank[owner], group))
        lead = np.append(True, group[by_place][1:] != group[by_place][:-1])
        earliest = by_place[lead]  # suffix rank of the earliest place, per group
        # The interval of a window without its last word.
        shorter = np.cumsum(~shared_prefix(text, order, width - 1)) - 1
        edge = np.flatnonzero(np.append(np.append(True, shorter[1:] != shorter[:-1]), True))

        # Backward search, all segments at once, from the last word to the first.
        low_, high = np.zeros(n, np.int64), np.full(n, len(text))
        found = np.full(int(windows.sum()), -1)
        base = np.cumsum(windows) - windows
        live = np.arange(n)
        for step in range(int(count.max())):
            live = live[count[live] > step]
            word = count[live] - 1 - step
            symbols = text[begin[live] + word]
            low_[live], high[live] = index.extend(symbols, low_[live], high[live])
            if step >= width - 1:
                found[base[live] + word] = low_[live]
                within = shorter[low_[live]]
                low_[live], high[live] = edge[within], edge[within + 1]
        # Runs of windows whose earliest places follow each other in one document.
        of = np.repeat(np.arange(n), windows)
        shift = np.arange(len(of)) - base[of]
        first_at = earliest[group[found]]
        doc, pos = owner[first_at], place[owner[first_at]] + offset[first_at]
        new = np.append(True, (of[1:] != of[:-1]) | (rank[doc][1:] != rank[doc][:-1]) | (pos[1:] != pos[:-1] + 1))
        run = np.flatnonzero(new)
        length = np.diff(np.append(run, len(of)))
        own = (rank[doc[run]] == rank[of[run]]) & (pos[run] == place[of[run]] + shift[run])
        keep = ~own | (table["_n"].to_numpy()[of[run]] > 1)
        run, length = run[keep], length[keep]
        who, where = pa.array(of[run]), pa.array(doc[run])
        yield pa.RecordBatch.from_arrays(
            [
                table["_key"].combine_chunks().take(who),
                table["_content"].combine_chunks().take(who),
                pa.array(shift[run]),
                pa.array(length),
                table["_id"].combine_chunks().take(where),
                table["_h"].combine_chunks().take(where),
                pa.array(pos[run]),
            ],
            ["_key", "_content", "_off", "_len", "_eid", "_eh", "_epos"],
        )

    return work


def repeats(docs: DataFrame, width: int = WINDOW, gram: int = GRAM, symbols=word_symbols, shard: int = SHARD) -> DataFrame:
    """(_rid, _rh, _cut): per document the word intervals [from, to) covered by repeats, for documents with any."""
    finder = Finder(docs, Shape(width, gram, symbols))
    id_type = docs.schema["_id"].dataType
    schema = T.StructType(
        [
            T.StructField("_key", T.LongType()),
            T.StructField("_content", T.LongType()),
            T.StructField("_off", T.LongType()),
            T.StructField("_len", T.LongType()),
            T.StructField("_eid", id_type),
            T.StructField("_eh", T.LongType()),
            T.StructField("_epos", T.LongType()),
        ]
    )
    earliest = materialize(shards(finder.contents(), shard, _index_shard(width), schema), "substring-earliest")
    both = finder.places().join(earliest, ["_key", "_content"])
    itself = F.col("_id").eqNullSafe(F.col("_eid")) & (F.col("_h") == F.col("_eh")) & (F.col("_start") + F.col("_off") == F.col("_epos"))
    begin = F.col("_start") + F.col("_off")
    cut = F.struct(begin.alias("a"), (begin + F.col("_len") - 1 + width).alias("b"))
    return both.where(~itself).groupBy(F.col("_id").alias("_rid"), F.col("_h").alias("_rh")).agg(F.collect_set(cut).alias("_cut"))


def covered(size: int, cuts: list) -> np.ndarray:
    """Which of ``size`` symbols lie in any of the intervals."""
    change = np.zeros(size + 1, np.int64)
    if cuts:
        a = np.array([(c["a"], c["b"]) for c in cuts], np.int64)
        np.add.at(change, a[:, 0], 1)
        np.add.at(change, a[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def with_cuts(docs: DataFrame, cuts: DataFrame) -> DataFrame:
    """(_id, _h, _text, _cut) of all documents."""
    same: Column = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_h") == F.col("_rh"))
    return docs.join(cuts, same, "left").select("_id", "_h", "_text", "_cut")


def substring_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256[, kept_text]."""
    arrow_rows(df.sparkSession)
    docs = keyed(df, id_col, text_col)
    cuts = materialize(repeats(docs), "substring-cuts")
    fields = [
        T.StructField(id_col, df.schema[id_col].dataType),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    if keep_text:
        fields.append(T.StructField("kept_text", T.StringType()))
    names = [f.name for f in fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(2)):
                starts, ends, first = spans(piece)
                data = piece.data.tobytes()
                lists = batch.column(3).slice(piece.first, piece.last - piece.first).to_pylist()
                total, gone, shas, texts = [], [], [], []
                for a, b, cuts_ in zip(first[:-1].tolist(), first[1:].tolist(), lists, strict=True):
                    s, e = starts[a:b], ends[a:b]
                    if cuts_:
                        stay = ~covered(b - a, cuts_)
                        s, e = s[stay], e[stay]
                    text = b" ".join([data[i:j] for i, j in zip(s.tolist(), e.tolist(), strict=True)])
                    total.append(b - a)
                    gone.append(b - a - len(s))
                    shas.append(hashlib.sha256(text).hexdigest())
                    if keep_text:
                        texts.append(text.decode())
                columns = [batch.column(0).slice(piece.first, piece.last - piece.first), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(shas, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(texts, pa.string())] if keep_text else []), names)

    return with_cuts(docs, cuts).mapInArrow(cut, T.StructType(fields))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
spots AS (SELECT r, p AS s, string_agg(x, ' ') OVER t AS passage, count(*) OVER t AS n FROM words
          WINDOW t AS (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
repeated AS (SELECT r, s FROM (
  SELECT r, s, row_number() OVER (PARTITION BY passage ORDER BY r, s) AS nth FROM spots WHERE n = 20) WHERE nth > 1),
judged AS (SELECT words.r, p, x, max(s) OVER (PARTITION BY words.r ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
           FROM words LEFT JOIN repeated ON repeated.r = words.r AND s = p),
result AS (SELECT r, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                  string_agg(x, ' ' ORDER BY p) FILTER (NOT gone) AS kept FROM judged GROUP BY r)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN result USING (r)
"""
