"""Licence scan: MinHash over overlapping windows retrieves templates, shingle containment verifies.

Words are runs of letters and digits, A-Z lower-cased, so punctuation, quotes
and comment signs do not matter. Every text is cut into blocks of shingles (five words), and two
neighbouring blocks form a window; windows overlap by half. Templates are
grouped by size: with blocks of L shingles, L a power of two and template sizes from L/2 + 1
to L, a passage holding 75 % of a template lies within a window, at a similarity of at least
(0.75 L/2) / (2 L + 0.25 L/2) = 0.17. A window is a candidate if any of ``BANDS`` bands of
one row agree: that happens with probability 1 - (1 - 0.17)**80 > 0.9999996.
(Bands of more rows would need many more hashes at this similarity; agreement of a
single row already means a shared shingle, so there are few false candidates.)

A candidate is a match if at least ``CONTAINMENT`` of the template's distinct
shingles stand in the window. If not, its two neighbouring blocks are read too, without the matches found before:
inserted words (a holder's name, page headers, line numbers) can spread a passage over up to 3 L + 1
shingles. Matches of one licence that overlap are one span. Blocks start
anew at every document, so the result depends on its text alone.

Documents are scanned where they are read, without a shuffle; the templates are a
parameter and travel with the tasks (their number bounds their size).

Defined results: null texts and texts of fewer than five words match
nothing. Repeated rows get equal results, an empty table an empty result; extra columns are
ignored. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.common import arrow_rows, text_of
from revtrace.llm.license_templates import TEMPLATES
from revtrace.llm.words import PUNCTUATION, Piece, hashes, mix, pieces, spans, windows

WIDTH = 5
BANDS = 80
CONTAINMENT = 0.75


class Library:
    """Templates with their shingles and band values, by block size."""

    def __init__(self, templates: list[tuple[str, str]]):
        self.odd = mix(np.arange(1, BANDS + 1, dtype=np.uint64)) | np.uint64(1)
        self.names = [name for name, _ in templates]
        self.shingles = []
        for _, text in templates:
            data = np.frombuffer(text.encode(), np.uint8)
            starts, ends, _ = spans(Piece(0, 1, data, np.array([0, len(data)])), PUNCTUATION)
            s = windows(hashes(data, starts, ends, fold=True), WIDTH)
            if not len(s):
                raise ValueError(f"a template needs {WIDTH} words: {text!r}")
            self.shingles.append(np.unique(s))
        self.by_size: dict[int, list[int]] = {}
        for k, s in enumerate(self.shingles):
            self.by_size.setdefault(max(4, 1 << (len(s) - 1).bit_length()), []).append(k)
        # The band values: for each band and template, the largest product of its shingles.
        self.bands = np.array([[(s * odd).max() for s in self.shingles] for odd in self.odd])

    def candidates(self, shingles: np.ndarray, begin: np.ndarray, count: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(template, document, block size, block) of the windows that agree in a band; a window is a block and the next.

        The documents have ``count`` shingles, one at least, from ``begin`` on; what lies between them is 0."""
        sizes = sorted(self.by_size)
        # Per size: where its blocks begin among those of half the size (the least: among shingles), how many each document has.
        levels, size, above, inside = [], sizes[0], begin, None
        while size <= sizes[-1]:
            n = -(-count // size)
            ends = np.cumsum(n)
            inside = np.arange(ends[-1]) - np.repeat(ends - n, n)
            levels.append((size, np.repeat(above, n) + inside * (2 if levels else size), n, inside))
            size, above = size * 2, ends - n
        found = {k: [] for k in range(len(self.names))}
        for band, odd in enumerate(self.odd):
            blocks = shingles * odd
            for size, at, n, inside in levels:
                blocks = np.maximum.reduceat(blocks, at)
                if size not in self.by_size:
                    continue
                window = blocks.copy()
                # A document's last block is a window of its own only if it has no other.
                np.maximum(blocks[:-1], blocks[1:], out=window[:-1], where=inside[1:] > 0)
                window[(inside > 0) & np.append(inside[1:] == 0, True)] = 0
                for k in self.by_size[size]:
                    hit = np.flatnonzero(window == self.bands[band, k])
                    if len(hit):
                        found[k].append(hit)
        for size, _, n, inside in levels:
            for k in self.by_size.get(size, ()):
                if found[k]:
                    hits = np.unique(np.concatenate(found[k]))
                    docs = np.searchsorted(np.cumsum(n), hits, "right")
                    for d, w in zip(docs.tolist(), inside[hits].tolist(), strict=True):
                        yield k, d, size, w

    def matches(self, piece: Piece) -> Iterator[tuple[int, str, int, int, float]]:
        """(document, licence, start byte, end byte, containment), counted from the piece's start."""
        starts, ends, first = spans(piece, PUNCTUATION)
        shingles = windows(hashes(piece.data, starts, ends, fold=True), WIDTH)
        count = np.diff(first) - WIDTH + 1
        docs = np.flatnonzero(count > 0)
        if not len(docs):
            return
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        shingles = np.where(doc[: len(shingles)] == doc[WIDTH - 1 :], shingles, np.uint64(0))
        begin, count = first[:-1][docs], count[docs]

        def held(k: int, d: int, a: int, b: int) -> np.ndarray:
            """Where the document's shingles from a up to b are the template's."""
            a, b = int(begin[d]) + max(a, 0), int(begin[d] + min(b, count[d]))
            return a + np.flatnonzero(np.isin(shingles[a:b], self.shingles[k]))

        whole: dict[tuple[int, int], list[tuple[int, int]]] = {}
        spread = []
        for k, d, size, w in self.candidates(shingles, begin, count):
            at = held(k, d, w * size, (w + 2) * size)
            share = len(np.unique(shingles[at])) / len(self.shingles[k])
            if share >= CONTAINMENT:
                whole.setdefault((k, d), []).append((int(at[0]), int(at[-1])))
                yield int(docs[d]), self.names[k], int(starts[at[0]]), int(ends[at[-1] + WIDTH - 1]), share
            else:
                spread.append((k, d, size, w))
        for k, d, size, w in spread:
            at = held(k, d, (w - 1) * size, (w + 3) * size)
            for a, b in whole.get((k, d), ()):
                at = at[(at < a) | (at > b)]
            share = len(np.unique(shingles[at])) / len(self.shingles[k])
            if share >= CONTAINMENT:
                yield int(docs[d]), self.names[k], int(starts[at[0]]), int(ends[at[-1] + WIDTH - 1]), share


def _merged(found: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    """Overlapping spans of one licence as one, by start."""
    out: list[list] = []
    for name, a, b, share in sorted(found):
        if out and out[-1][0] == name and a < out[-1][2]:
            out[-1][2], out[-1][3] = max(b, out[-1][2]), max(share, out[-1][3])
        else:
            out.append([name, a, b, share])
    return sorted((tuple(x) for x in out), key=lambda x: (x[1], x[0]))


def scan_licenses(
    df: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_matches, licenses (sorted names), matches (license, start, end, containment)."""
    arrow_rows(df.sparkSession)
    match = T.StructType(
        [
            T.StructField("license", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("containment", T.DoubleType()),
        ]
    )
    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField("n_matches", T.LongType()),
            T.StructField("licenses", T.ArrayType(T.StringType())),
            T.StructField("matches", T.ArrayType(match)),
        ]
    )
    names = schema.names
    arrow = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = Library(templates)
        for batch in batches:
            for piece in pieces(batch.column(1)):
                found: list[list] = [[] for _ in range(piece.last - piece.first)]
                for d, *rest in library.matches(piece):
                    found[d].append(tuple(rest))
                rows = []
                for d, spans_ in enumerate(found):
                    text = piece.data[piece.offsets[d] : piece.offsets[d + 1]]
                    # Code points: bytes that do not continue a character.
                    points = np.cumsum(np.append(0, (text & 0xC0) != 0x80)) if spans_ else None
                    low = int(piece.offsets[d])
                    rows.append([(n, int(points[a - low]), int(points[b - low]), s) for n, a, b, s in _merged(spans_)])
                matches = [[dict(zip(match.names, r, strict=True)) for r in row] for row in rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(piece.first, piece.last - piece.first),
                        pa.array([len(r) for r in rows], pa.int64()),
                        pa.array([sorted({m[0] for m in r}) for r in rows], pa.list_(pa.string())),
                        pa.array(matches, arrow),
                    ],
                    names,
                )

    return df.select(F.col(f"`{id_col}`").alias("_id"), text_of(text_col).alias("_text")).mapInArrow(scan, schema)
