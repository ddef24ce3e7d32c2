"""Benchmark decontamination by greedy string tiling.

Words are compared with A-Z lower-cased, as 64-bit hashes.

1. *Seeds.* All five-word windows of the benchmark set bits in a bitmap of fixed
   size (``BITS`` bits, whatever the benchmark's size). Every document is read
   whole, and the stretches whose windows hit the bitmap are kept; every
   tile of any item lies inside them.
2. *Join on shared seeds.* The seeds of the stretches meet the benchmark's
   seeds in a shuffle join. A qualifying document shares at least 15 % of an
   item's seeds (tiles of five words covering 75 % of it), so the most
   frequent seeds of an item, up to one less than that, are left out: any
   qualifying pair still meets through the others.
3. *Tiling.* For each pair the longest common unmarked runs of words are
   marked again and again, found with running Karp-Rabin hashes of falling
   length, down to five words. Tiles may come in any order, so reordered
   passages are caught.
4. *Threshold.* A document is contaminated if the tiles of an item cover at
   least ``threshold`` of that item's words.

Items with fewer than five words count as one seed and must be found whole.

Defined results: null texts and texts without words are clean; such items
match nothing. Rows repeating id and text get equal rows; benchmark rows that repeat id
and text are one item. Empty tables give clean documents or no rows. Extra
columns on either side are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.common import arrow_rows, carried, keyed, materialize, text_of
from revtrace.llm.words import cached_powers, hashes, inverse, pieces, spans, windows

WIDTH = 5
BITS = 1 << 24
THRESHOLD = 0.75

_KR = np.uint64(0xA0761D6478BD642F)


def _rolling(values: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``width`` values."""
    n = len(values)
    if n < width:
        return np.empty(0, np.uint64)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * cached_powers(_KR, n), out=total[1:])
    return (total[width:] - total[:-width]) * cached_powers(inverse(_KR), n - width + 1)


def tiles(item: np.ndarray, doc: np.ndarray, least: int = WIDTH) -> list[tuple[int, int, int]]:
    """(start in item, start in doc, length) of a greedy tiling, longest match first.

    Ties go to the earliest start in the item, then in the document.
    """
    used_i, used_d = np.zeros(len(item), bool), np.zeros(len(doc), bool)
    found: list[tuple[int, int, int]] = []
    size = max(least, min(len(item), len(doc)))
    while True:
        free_i = np.convolve(used_i, np.ones(size, int), "valid") == 0 if len(item) >= size else np.empty(0, bool)
        free_d = np.convolve(used_d, np.ones(size, int), "valid") == 0 if len(doc) >= size else np.empty(0, bool)
        hi, hd = _rolling(item, size), _rolling(doc, size)
        at_d = np.flatnonzero(free_d & np.isin(hd, hi)) if len(hi) else np.empty(0, int)
        where: dict[int, list[int]] = {}
        for t in at_d.tolist():
            where.setdefault(int(hd[t]), []).append(t)
        matches = []
        for p in np.flatnonzero(free_i).tolist() if where else []:
            for t in where.get(int(hi[p]), ()):
                if p and t and item[p - 1] == doc[t - 1] and not used_i[p - 1] and not used_d[t - 1]:
                    continue  # part of a match that starts earlier
                m = min(len(item) - p, len(doc) - t)
                stop = (item[p : p + m] != doc[t : t + m]) | used_i[p : p + m] | used_d[t : t + m]
                k = int(stop.argmax()) if stop.any() else m
                if k >= size:
                    matches.append((-k, p, t))
        heapq.heapify(matches)
        while matches:
            k, p, t = heapq.heappop(matches)
            taken = used_i[p : p - k] | used_d[t : t - k]
            if not taken.any():
                used_i[p : p - k] = used_d[t : t - k] = True
                found.append((p, t, -k))
                continue
            edge = np.flatnonzero(np.diff(np.concatenate(([1], taken, [1]))))  # what is left of it
            for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                if b - a >= size:
                    heapq.heappush(matches, (a - b, p + a, t + a))
        if size == least:
            return sorted(found)
        size = max(least, size // 2)


def _words(piece) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, first = spans(piece)
    return hashes(piece.data, starts, ends, fold=True), first


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in pieces(batch.column(2)):
            h, first = _words(piece)
            words, seeds = [], []
            for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
                words.append(h[a:b].view(np.int64))
                seeds.append(windows(h[a:b], min(WIDTH, b - a)).view(np.int64) if b > a else words[-1])
            ids = [c.slice(piece.first, piece.last - piece.first) for c in batch.columns[:2]]
            arrays = [pa.array(x, pa.list_(pa.int64())) for x in (words, seeds)]
            yield pa.RecordBatch.from_arrays([*ids, *arrays], ["_item", "_ih", "_words", "_seeds"])


def _benchmark(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("_item", bench.schema[id_col].dataType),
            T.StructField("_ih", T.LongType()),
            T.StructField("_words", T.ArrayType(T.LongType())),
            T.StructField("_seeds", T.ArrayType(T.LongType())),
        ]
    )
    rows = keyed(bench, id_col, text_col).mapInArrow(_item_rows, schema)
    return materialize(rows.dropDuplicates(["_item", "_ih"]), "decontaminate-items")


def _bitmap(items: DataFrame) -> bytes:
    """The seeds' bitmap: at most BITS / 64 rows come to the driver."""
    bit = items.select(F.explode("_seeds").alias("_s")).select(F.pmod("_s", F.lit(BITS)).alias("_b"))
    slot = bit.groupBy(F.shiftright("_b", 6).alias("_w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_b & 63 as int))")).alias("_m")
    )
    out = np.zeros(BITS // 64, np.int64)
    for r in slot.toLocalIterator():
        out[r["_w"]] = r["_m"]
    return out.tobytes()


def _stretches(docs: DataFrame, id_type, packed: bytes, widths: list[int]) -> DataFrame:
    """(_id, _h, _start, _words, _seeds): maximal stretches of words under windows that hit the bitmap."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(packed, np.uint8), bitorder="little").view(bool)
        for batch in batches:
            for piece in pieces(batch.column(2)):
                h, first = _words(piece)
                cover = np.zeros(len(h) + 1, np.int64)
                hits = []
                for w in widths:
                    s = windows(h, w)
                    # A window must not reach into the next document.
                    doc_end = np.repeat(first[1:], np.diff(first))[: len(s)]
                    at = np.flatnonzero(bits[(s & np.uint64(BITS - 1)).astype(np.int64)] & (np.arange(len(s)) + w <= doc_end))
                    np.add.at(cover, at, 1)
                    np.add.at(cover, at + w, -1)
                    hits.append((at, s[at]))
                edge = np.diff(np.concatenate(([False], np.cumsum(cover[:-1]) > 0, [False])).astype(np.int8))
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                # Stretches of neighbouring documents may touch: cut them at the document's start.
                cut = first[1:-1]
                cut = cut[(cut > 0) & (cut < len(h))]
                inner = cut[np.searchsorted(begin, cut, "right") > np.searchsorted(end, cut, "right")]
                inner = np.setdiff1d(inner, begin)
                begin, end = np.union1d(begin, inner).astype(np.int64), np.union1d(end, inner).astype(np.int64)
                if not len(begin):
                    continue
                at = np.concatenate([a for a, _ in hits])
                seed = np.concatenate([s for _, s in hits])
                order = np.argsort(at, kind="stable")
                at, seed = at[order], seed[order].view(np.int64)
                low, high = np.searchsorted(at, begin), np.searchsorted(at, end)
                words = [h[a:b].view(np.int64) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
                seeds = [seed[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                doc = np.searchsorted(first, begin, "right") - 1
                rows = pa.array(doc + piece.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(begin - first[doc], pa.int64()),
                        pa.array(words, pa.list_(pa.int64())),
                        pa.array(seeds, pa.list_(pa.int64())),
                    ],
                    ["_id", "_h", "_start", "_words", "_seeds"],
                )

    schema = T.StructType(
        [
            T.StructField("_id", id_type),
            T.StructField("_h", T.LongType()),
            T.StructField("_start", T.LongType()),
            T.StructField("_words", T.ArrayType(T.LongType())),
            T.StructField("_seeds", T.ArrayType(T.LongType())),
        ]
    )
    return materialize(docs.mapInArrow(scan, schema).dropDuplicates(["_id", "_h", "_start"]), "decontaminate-stretches")


def _index(items: DataFrame) -> DataFrame:
    """(_s, _item, _ih): each item's distinct seeds but for its most frequent ones, fewer than any match needs."""
    seeds = items.select("_item", "_ih", F.size("_words").alias("_len"), F.explode(F.array_distinct("_seeds")).alias("_s"))
    often = seeds.groupBy("_s").agg(F.count(F.lit(1)).alias("_df"))
    by_item = seeds.join(often, "_s").groupBy("_item", "_ih", "_len").agg(
        F.array_sort(F.collect_list(F.struct("_df", "_s"))).alias("_all")
    )
    # Tiles cover THRESHOLD * len words, each tile of five words or more holds a seed at its start;
    # repeated seeds make distinct ones fewer, so only items without repeats drop any.
    need = F.ceil(F.col("_len") * THRESHOLD / (2 * WIDTH - 1)).cast("int")
    spare = F.when(F.size("_all") == F.greatest(F.col("_len") - WIDTH + 1, F.lit(1)), need - 1).otherwise(0)
    kept = F.slice("_all", F.lit(1), F.greatest(F.size("_all") - spare, F.lit(1)))
    return by_item.select("_item", "_ih", F.explode(kept).alias("_x")).select("_x._s", "_item", "_ih")


def _coverage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    gap = np.zeros(1, np.uint64)
    for batch in batches:
        share = []
        for runs, words in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
            item = np.array(words, np.int64).view(np.uint64)
            parts = []
            for r in sorted(runs, key=lambda r: r["_start"]):
                parts += [np.array(r["_words"], np.int64).view(np.uint64), gap]
            doc = np.concatenate(parts)
            share.append(sum(k for _, _, k in tiles(item, doc, min(WIDTH, len(item)))) / len(item))
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(share, pa.float64())], ["_id", "_h", "_item", "_ih", "_share"])


def coverage(df: DataFrame, bench: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """(_id, _h, _item, _ih, _share): the share of each item's words tiled by a document, for pairs sharing a seed."""
    spark = df.sparkSession
    arrow_rows(spark)
    items = _benchmark(bench, item_col, item_text)
    widths = [r[0] for r in items.where("size(_words) > 0").select(F.least(F.size("_words"), F.lit(WIDTH))).distinct().collect()]
    runs = _stretches(keyed(df, id_col, text_col), df.schema[id_col].dataType, _bitmap(items), sorted(widths) or [WIDTH])
    seeds = runs.select("_id", "_h", F.explode("_seeds").alias("_s")).distinct()
    pairs = materialize(seeds.join(_index(items), "_s").select("_id", "_h", "_item", "_ih").distinct(), "decontaminate-pairs")
    whole = runs.groupBy("_id", "_h").agg(F.collect_list(F.struct("_start", "_words")).alias("_runs"))
    a, b, c = pairs.alias("a"), whole.alias("b"), items.alias("c")
    rows = a.join(b, F.col("a._id").eqNullSafe(F.col("b._id")) & (F.col("a._h") == F.col("b._h")))
    rows = rows.join(c, F.col("a._item").eqNullSafe(F.col("c._item")) & (F.col("a._ih") == F.col("c._ih")))
    rows = rows.select("a._id", "a._h", "a._item", "a._ih", "b._runs", "c._words")
    schema = T.StructType([*pairs.schema.fields, T.StructField("_share", T.DoubleType())])
    return rows.mapInArrow(_coverage, schema)


def decontaminate(
    df: DataFrame,
    bench: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document row: id, contaminated, n_items, max_coverage, items (sorted ids), _h (the text's hash)."""
    if threshold < THRESHOLD:
        raise ValueError(f"seeds are chosen for a threshold of {THRESHOLD} or more")
    found = coverage(df, bench, id_col, text_col, item_col, item_text).where(F.col("_share") >= threshold)
    hits = found.groupBy(F.col("_id").alias("_did"), F.col("_h").alias("_dh")).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.max("_share").alias("max_coverage"),
        F.array_sort(F.collect_set("_item")).alias("items"),
    )
    hits = materialize(hits, "decontaminate-hits")
    rows = keyed(df, id_col, text_col).select("_id", "_h")
    out = rows.join(hits, F.col("_id").eqNullSafe(F.col("_did")) & (F.col("_h") == F.col("_dh")), "left")
    return out.select(
        F.col("_id").alias(id_col),
        F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("max_coverage", F.lit(0.0)).alias("max_coverage"),
        F.coalesce("items", F.array().cast(T.ArrayType(bench.schema[item_col].dataType))).alias("items"),
        "_h",
    )


def keep_clean(df: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows, all columns, that are not contaminated."""
    found = coverage(df, bench, id_col, text_col, "item_id", "text").where(F.col("_share") >= THRESHOLD)
    hits = materialize(found.select(F.col("_id").alias("_did"), F.col("_h").alias("_dh")).distinct(), "decontaminate-hits")
    rows = carried(df, _id=F.col(f"`{id_col}`"), _th=F.xxhash64(text_of(text_col)))
    hit = F.col("_id").eqNullSafe(F.col("_did")) & (F.col("_th") == F.col("_dh"))
    return rows.join(hits, hit, "left_anti").select("_row.*")
