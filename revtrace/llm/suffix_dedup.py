"""Suffix-array deduplication: bytes of passages that stand anywhere else too are removed.

A string of ``WINDOW`` bytes is repeated if it starts at another place as well, in
the same document or another. All bytes under repeated strings go, at every
place; overlaps count, and strings are judged on the input.

Documents meet only where they can share a string (``segments``). Every shard sorts the
suffixes of its segments by external induced sorting with common-prefix
values: neighbours sharing ``WINDOW`` bytes or more are repeats. What a shard finds
goes back to every document holding the segment, by a join on key and content.

Texts are compared as UTF-8 bytes; matches never cross documents (or segments,
which a separator ends). Shards hold about ``SHARD`` bytes; the lists of the sort go to scratch
files of the task beyond their memory budget.

Defined results: a null text counts as empty. Texts shorter than a window keep all
bytes. Rows repeating id and text are one document, read once, and get equal rows. An
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.common import arrow_rows, keyed, materialize
from revtrace.llm.induced_sort import suffixes
from revtrace.llm.segments import Finder, Shape, Symbols, shards
from revtrace.llm.substring_dedup import covered, with_cuts
from revtrace.llm.words import BYTES, Piece, pieces

WINDOW = 400
GRAM = 64
SHARD = 6 << 20


def byte_symbols(piece: Piece) -> Symbols:
    return Symbols(BYTES[piece.data], None, None, piece.offsets)


def repeated(text: np.ndarray, width: int) -> np.ndarray:
    """Which positions start a string of ``width`` symbols that starts elsewhere too."""
    out = np.zeros(len(text), bool)
    last = -1
    for position, prefix in suffixes(text, width):
        before = np.append(np.int32(last), position[:-1])
        hit = prefix >= width
        out[position[hit]] = True
        out[before[hit]] = True
        last = int(position[-1])
    return out


def _sort_shard(width: int):
    def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        if not n:
            return
        raw = table["_text"].combine_chunks()
        offsets = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + n + 1].astype(np.int64)
        data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets -= offsets[0]
        # Symbol 0 ends every segment.
        segment = np.repeat(np.arange(n), np.diff(offsets))
        text = np.zeros(len(data) + n, np.int16)
        text[np.arange(len(data)) + segment] = data.astype(np.int16) + 1
        begin = offsets[:-1] + np.arange(n)
        hits = repeated(text, width)
        windows = np.diff(offsets) - width + 1
        base = np.cumsum(windows) - windows
        of = np.repeat(np.arange(n), windows)
        shift = np.arange(len(of)) - base[of]
        hit = hits[begin[of] + shift] | (table["_n"].to_numpy()[of] > 1)
        turn = np.append(True, (of[1:] != of[:-1]) | (hit[1:] != hit[:-1]))
        run = np.flatnonzero(turn)
        length = np.diff(np.append(run, len(of)))
        keep = hit[run]
        run, length = run[keep], length[keep]
        who = pa.array(of[run])
        yield pa.RecordBatch.from_arrays(
            [table["_key"].combine_chunks().take(who), table["_content"].combine_chunks().take(who), pa.array(shift[run]), pa.array(length)],
            ["_key", "_content", "_off", "_len"],
        )

    return work


def repeats(docs: DataFrame, width: int = WINDOW, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """(_rid, _rh, _cut): per document the byte intervals [from, to) under repeated strings, for documents with any."""
    twice = docs.groupBy("_id", "_h").agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1")
    if not twice.isEmpty():  # a repeated row is no other place
        docs = docs.dropDuplicates(["_id", "_h"])
    finder = Finder(docs, Shape(width, gram, byte_symbols))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("_key", "_content", "_off", "_len")])
    hits = materialize(shards(finder.contents(), shard, _sort_shard(width), schema), "suffix-hits")
    begin = F.col("_start") + F.col("_off")
    cut = F.struct(begin.alias("a"), (begin + F.col("_len") - 1 + width).alias("b"))
    return finder.places().join(hits, ["_key", "_content"]).groupBy(F.col("_id").alias("_rid"), F.col("_h").alias("_rh")).agg(F.collect_set(cut).alias("_cut"))


def suffix_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_bytes: bool = True) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256[, kept (the bytes that stay)]."""
    arrow_rows(df.sparkSession)
    docs = keyed(df, id_col, text_col)
    cuts = materialize(repeats(docs), "suffix-cuts")
    fields = [
        T.StructField(id_col, df.schema[id_col].dataType),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
    ]
    if keep_bytes:
        fields.append(T.StructField("kept", T.BinaryType()))
    names = [f.name for f in fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch.column(2)):
                lists = batch.column(3).slice(piece.first, piece.last - piece.first).to_pylist()
                total, gone, spans, shas, kept = [], [], [], [], []
                for a, b, cuts_ in zip(piece.offsets[:-1].tolist(), piece.offsets[1:].tolist(), lists, strict=True):
                    text = piece.data[a:b]
                    n = 0
                    if cuts_:
                        out = covered(b - a, cuts_)
                        text = text[~out]
                        n = int(np.count_nonzero(out[1:] & ~out[:-1])) + int(out[0])
                    total.append(b - a)
                    gone.append(b - a - len(text))
                    spans.append(n)
                    text = text.tobytes()
                    shas.append(hashlib.sha256(text).hexdigest())
                    if keep_bytes:
                        kept.append(text)
                columns = [batch.column(0).slice(piece.first, piece.last - piece.first)]
                columns += [pa.array(x, pa.int64()) for x in (total, gone, spans)] + [pa.array(shas, pa.string())]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(kept, pa.binary())] if keep_bytes else []), names)

    return with_cuts(docs, cuts).mapInArrow(cut, T.StructType(fields))
