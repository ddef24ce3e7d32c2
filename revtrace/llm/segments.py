"""Finding repeated windows of a text collection: routing equal windows to one place.

A *window* is ``width`` consecutive symbols (words or bytes) of one document. Its
*anchor* is the smallest hash among its runs of ``gram`` symbols. Equal
windows have equal anchors, so a *segment* (neighbouring windows with one
anchor, sent as the text they cover) meets every equal window under its anchor's
key. Each text is read in a few passes; only what may repeat is shuffled:

1. anchors are counted over all documents (partial sums first). Two bitmaps of
   fixed size, ``BITS`` bits each, mark keys seen twice or more and hot keys, seen more
   than ``HOT`` times;
2. the windows of hot keys are counted by their own hash, into a third bitmap, and
   become segments of one window each, so a hot anchor spreads over as many keys
   as it has different windows;
3. marked segments go to their key's shard: one row per key and content from each batch
   of documents, the text itself once per task.

A bitmap may mark too much, never too little, and marks the same for all
documents: results do not depend on its size, only the volume shuffled does.

Documents are ordered by id (nulls first), then by the hash of the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.words import cached_powers, inverse, mix, pieces

BITS = 1 << 26
HOT = 50_000
#: A segment has at most so many windows (any cut is right, windows are independent).
RUN = 512

_ROLL = np.uint64(0xE7037ED1A0B428DB)


@dataclass
class Symbols:
    """Symbols of the documents of a piece: hashes, byte spans, and each document's first symbol."""

    values: np.ndarray
    starts: np.ndarray | None  # byte positions; None: symbol k is byte k
    ends: np.ndarray | None
    first: np.ndarray

    def text(self, data: np.ndarray, a: int, b: int) -> bytes:
        if self.starts is None:
            return data[a:b].tobytes()
        return data[self.starts[a] : self.ends[b - 1]].tobytes()


@dataclass
class Segments:
    doc: np.ndarray
    start: np.ndarray  # symbol, counted from the piece's start
    count: np.ndarray  # windows
    key: np.ndarray
    content: np.ndarray  # hash of all symbols covered
    single: np.ndarray  # one window of a hot anchor: its key is its content

    def take(self, at: np.ndarray) -> Segments:
        return Segments(*(getattr(self, f.name)[at] for f in fields(self)))


class Rolling:
    """Hashes of runs of symbols."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.inv = cached_powers(inverse(_ROLL), n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(values * cached_powers(_ROLL, n + 1)[:n], out=self.total[1:])

    def fixed(self, width: int) -> np.ndarray:
        n = len(self.total) - width
        return mix((self.total[width:] - self.total[:n]) * self.inv[:n] + np.uint64(width))

    def spans(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.total[b] - self.total[a]) * self.inv[a] + (b - a).astype(np.uint64))


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbouring values."""
    span, m = 1, g
    while 2 * span <= width:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return np.minimum(m[: len(g) - width + 1], m[width - span :]) if span < width else m


@dataclass
class Shape:
    width: int
    gram: int
    symbols: Callable  # Piece -> Symbols

    def segments(self, piece, hot: np.ndarray | None) -> tuple[Symbols, Rolling | None, Segments | None]:
        """The piece's segments. Those with an anchor marked in ``hot`` are cut into single windows."""
        s = self.symbols(piece)
        if len(s.values) < self.width:
            return s, None, None
        roll = Rolling(s.values)
        anchor = _least(roll.fixed(self.gram), self.width - self.gram + 1)
        whole = np.flatnonzero(np.diff(s.first) >= self.width)  # documents with a window
        if not len(whole):
            return s, roll, None
        begin = s.first[:-1][whole]
        live = np.zeros(len(anchor) + 1, np.int8)
        np.add.at(live, begin, 1)
        np.add.at(live, s.first[1:][whole] - self.width + 1, -1)
        live = np.cumsum(live[:-1], dtype=np.int8).astype(bool)
        turn = live.copy()
        turn[1:] &= (anchor[1:] != anchor[:-1]) | ~live[:-1]
        turn[begin] = True
        start = np.flatnonzero(turn)
        doc = np.searchsorted(s.first, start, "right") - 1
        stop = np.minimum(np.append(start[1:], len(anchor)), s.first[doc + 1] - self.width + 1)
        key, count = anchor[start], stop - start
        single = marked(hot, key) if hot is not None else np.zeros(len(start), bool)
        limit = np.where(single, 1, RUN)
        parts = -(-count // limit)
        if (parts > 1).any():
            each = np.repeat(np.arange(len(start)), parts)
            nth = np.arange(len(each)) - np.repeat(np.cumsum(parts) - parts, parts)
            start, doc, key, single = start[each] + nth * limit[each], doc[each], key[each], single[each]
            count = np.minimum(limit[each], stop[each] - start)
        content = roll.spans(start, start + count - 1 + self.width)
        return s, roll, Segments(doc, start, count, np.where(single, content, key), content, single)

    def recurs(self, roll: Rolling, found: Segments) -> np.ndarray:
        """Whether a segment's anchor stands at several places in it (it may then repeat its own windows)."""
        grams = roll.fixed(self.gram)
        low = np.uint64((1 << max(24, len(grams).bit_length())) - 1)
        few = np.zeros(1 << 20, bool)
        few[(found.key & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        at = np.flatnonzero(few[(grams & np.uint64((1 << 20) - 1)).astype(np.int64)])
        where = np.sort((grams[at] & ~low) | at.astype(np.uint64))
        key, reach = found.key & ~low, self.width - self.gram
        first = np.searchsorted(where, key | found.start.astype(np.uint64))
        last = np.searchsorted(where, key | (found.start + found.count - 1 + reach).astype(np.uint64), "right")
        return last - first > 1


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = (keys & np.uint64(BITS - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def bitmaps(counts: DataFrame, conditions: list) -> list[bytes | None]:
    """A bitmap of BITS bits of the keys under each condition; at most BITS / 64 rows reach the driver."""
    bit = F.pmod("_key", F.lit(BITS))
    mask = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    rows = counts.withColumn("_bit", bit).where(conditions[0])
    words = rows.groupBy(F.shiftright("_bit", 6).alias("_word")).agg(
        *[F.bit_or(F.when(c, mask).otherwise(F.lit(0).cast("long"))).alias(f"_m{k}") for k, c in enumerate(conditions)]
    )
    got = words.toArrow()
    out = []
    for k in range(len(conditions)):
        bits, masks = np.zeros(BITS // 64, np.int64), got[f"_m{k}"].to_numpy()
        bits[got["_word"].to_numpy()] = masks
        out.append(bits.tobytes() if masks.any() else None)
    return out


class Finder:
    """The passes over (_id, _h, _text). ``id_type`` is the type of _id."""

    def __init__(self, rows: DataFrame, shape: Shape):
        self.rows, self.shape = rows, shape
        self.spark = rows.sparkSession
        self.id_type = rows.schema["_id"].dataType
        repeated, hot = bitmaps(self._counts(None), [F.col("_n") > 1, F.col("_n") > HOT])
        again = None
        if hot is not None:
            (again,) = bitmaps(self._counts(self._share(hot)), [F.col("_n") > 1])
        empty = bytes(BITS // 8)
        self.maps = self._share((repeated or empty, hot, again or empty if hot is not None else None))

    def _share(self, value):
        return self.spark.sparkContext.broadcast(value)

    def _counts(self, hot) -> DataFrame:
        """(_key, _n): how often each anchor occurs, or with ``hot`` each window of the hot anchors."""
        shape = self.shape

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.frombuffer(hot.value, np.uint8) if hot is not None else None
            for batch in batches:
                for piece in pieces(batch.column(2)):
                    _, roll, found = shape.segments(piece, bits)
                    if found is None:
                        continue
                    if bits is not None:
                        found = found.take(np.flatnonzero(found.single))
                        key, n = found.key, np.ones(len(found.key), np.int64)
                    else:
                        key, n = found.key, 1 + shape.recurs(roll, found)
                    key, where = np.unique(key, return_inverse=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(np.bincount(where, n, len(key)).astype(np.int64))], ["_key", "_n"]
                    )

        rows = self.rows.mapInArrow(count, "_key long, _n long")
        return rows.groupBy("_key").agg(F.sum("_n").alias("_n"))

    def _found(self):
        """A function giving the marked segments of each piece of a batch."""
        shape, maps = self.shape, self.maps

        def found(batch: pa.RecordBatch):
            repeated, hot, again = (np.frombuffer(m, np.uint8) if m is not None else None for m in maps.value)
            for piece in pieces(batch.column(2)):
                s, _, seg = shape.segments(piece, hot)
                if seg is None:
                    continue
                keep = marked(repeated, seg.key)
                if hot is not None:
                    keep = np.where(seg.single, marked(again, seg.key), keep)
                if keep.any():
                    yield piece, s, seg.take(np.flatnonzero(keep))

        return found

    def contents(self) -> DataFrame:
        """(_key, _content, _id, _h, _start, _count, _n, _text): what goes to the shards.

        One row per batch of documents: the earliest place there, the number of places, the
        text covered (null if this task has sent it already).
        """
        found, width = self._found(), self.shape.width

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sent: set[tuple[int, int]] = set()
            for batch in batches:
                rank = _ranks(batch.column(0), batch.column(1))
                for piece, s, seg in found(batch):
                    row = seg.doc + piece.first
                    start = seg.start - s.first[seg.doc]
                    order = np.lexsort((start, rank[row], seg.content, seg.key))
                    key, content = seg.key[order], seg.content[order]
                    new = np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1]))
                    at = order[new]
                    size = np.diff(np.append(np.flatnonzero(new), len(order)))
                    texts = []
                    for i, k, c in zip(at.tolist(), seg.key[at].tolist(), seg.content[at].tolist(), strict=True):
                        if (k, c) in sent:
                            texts.append(None)
                            continue
                        if len(sent) > 500_000:
                            sent.clear()
                        sent.add((k, c))
                        a = int(seg.start[i])
                        texts.append(s.text(piece.data, a, a + int(seg.count[i]) - 1 + width))
                    rows = pa.array(row[at])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(seg.key[at].view(np.int64)),
                            pa.array(seg.content[at].view(np.int64)),
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                            pa.array(start[at]),
                            pa.array(seg.count[at].astype(np.int32)),
                            pa.array(size),
                            pa.array(texts, pa.binary()),
                        ],
                        ["_key", "_content", "_id", "_h", "_start", "_count", "_n", "_text"],
                    )

        schema = T.StructType(
            [
                T.StructField("_key", T.LongType()),
                T.StructField("_content", T.LongType()),
                T.StructField("_id", self.id_type),
                T.StructField("_h", T.LongType()),
                T.StructField("_start", T.LongType()),
                T.StructField("_count", T.IntegerType()),
                T.StructField("_n", T.LongType()),
                T.StructField("_text", T.BinaryType()),
            ]
        )
        return self.rows.mapInArrow(send, schema)

    def places(self) -> DataFrame:
        """(_key, _content, _id, _h, _start): every marked segment of every document."""
        found = self._found()

        def list_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece, s, seg in found(batch):
                    rows = pa.array(seg.doc + piece.first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(seg.key.view(np.int64)),
                            pa.array(seg.content.view(np.int64)),
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                            pa.array(seg.start - s.first[seg.doc]),
                        ],
                        ["_key", "_content", "_id", "_h", "_start"],
                    )

        schema = T.StructType(
            [
                T.StructField("_key", T.LongType()),
                T.StructField("_content", T.LongType()),
                T.StructField("_id", self.id_type),
                T.StructField("_h", T.LongType()),
                T.StructField("_start", T.LongType()),
            ]
        )
        return self.rows.mapInArrow(list_, schema)


def _ranks(ids: pa.Array, hashes: pa.Array) -> np.ndarray:
    """The dense rank of each row's document: by id, nulls first, then by hash."""
    table = pa.table({"i": ids, "h": hashes})
    order = pc.sort_indices(table, [("i", "ascending"), ("h", "ascending")], null_placement="at_start").to_numpy()
    known = np.array(ids.is_valid())[order]
    same = np.ones(max(len(order) - 1, 0), bool)
    if len(order) > 1:
        t = table.take(pa.array(order))
        a, b = t.slice(0, len(order) - 1), t.slice(1)
        equal = pc.fill_null(pc.equal(a["i"], b["i"]), False).to_numpy()
        equal |= ~known[:-1] & ~known[1:]
        same = equal & pc.equal(a["h"], b["h"]).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(~same)))[: len(order)]
    return rank


def shards(contents: DataFrame, limit: int, work: Callable, schema: T.StructType) -> DataFrame:
    """Run ``work(table)`` over shards of about ``limit`` text bytes, each holding whole keys.

    A table has one row per (key, content): _key, _content, _count, _n (places), _text, and the earliest place
    _id, _h, _start. ``work`` yields record batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.column(7).nbytes
            if size >= limit:
                table = pa.concat_tables(held).combine_chunks()
                keys = table["_key"].to_numpy()
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if cut:
                    yield from work(merged(table.slice(0, cut)))
                    held = [table.slice(cut)]
                    size = sum(c.nbytes for c in held[0]["_text"].chunks)
        if held:
            yield from work(merged(pa.concat_tables(held).combine_chunks()))

    return contents.repartition("_key").sortWithinPartitions("_key").mapInArrow(run, schema)


def merged(table: pa.Table) -> pa.Table:
    """The rows of one (key, content) as one: earliest place, number of places, text."""
    if not table.num_rows:
        return table
    rank = _ranks(table["_id"].combine_chunks(), table["_h"].combine_chunks())
    key, content, start = (table[c].to_numpy() for c in ("_key", "_content", "_start"))
    order = np.lexsort((start, rank, content, key))
    k, c = key[order], content[order]
    new = np.append(True, (k[1:] != k[:-1]) | (c[1:] != c[:-1]))
    group = np.cumsum(new) - 1
    total = np.bincount(group, table["_n"].to_numpy()[order]).astype(np.int64)
    has = np.array(table["_text"].combine_chunks().is_valid())[order]
    sender = np.zeros(len(total), np.int64)
    sender[group[has][::-1]] = order[has][::-1]
    first = order[new]
    out = table.take(pa.array(first)).drop(["_n", "_text"])
    out = out.append_column("_rank", pa.array(rank[first]))
    out = out.append_column("_n", pa.array(total))
    return out.append_column("_text", table["_text"].combine_chunks().take(pa.array(sender)))
