"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct pre-tokens ("words") of a batch of documents form one small
corpus. An inverted index maps the rank of every adjacent token pair to the
word positions where the pair stands. Ranks are replayed in ascending order
over the whole batch at once; a merge touches only the merged position and its
two neighbours, whose pairs move to their new ranks in the index. The ids of a
word are then looked up by every document that contains it.

A merge can in principle create a pair of *lower* rank than the one being
replayed. The rest of that word is then put back, so the lower rank is applied
first: the result is the one of merging each word on its own, lowest rank
first and leftmost first. A word that is itself a token gets that token's id at once.

Documents are encoded where they are read: no shuffle, no broadcast. Every worker process
reads the rank file from its path (the same file must be on every machine) and keeps it, with the
words it has encoded, for the tasks that follow. The memory of a task is bounded by a batch of rows plus a word cache of
``CACHE_WORDS`` entries, which is emptied when full and changes no result.

Defined results: a null text counts as empty (no tokens). Repeated rows are
encoded alike, an empty table gives an empty result, and extra columns are
ignored. Any text round-trips: decoding gives its UTF-8 bytes.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
from collections.abc import Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.common import arrow_rows, text_of

CACHE_WORDS = 400_000


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Merges:
    """A rank file as lookups: the rank of any two adjacent tokens (``NONE`` if they do not merge)."""

    NONE = 1 << 30

    def __init__(self, ranks: dict[bytes, int]):
        self.byte_ids = np.full(256, -1, np.int64)
        for b in range(256):
            self.byte_ids[b] = ranks[bytes((b,))]
        pairs = {}
        for name, rank in ranks.items():
            for cut in range(1, len(name)):
                a, b = ranks.get(name[:cut]), ranks.get(name[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k] for k in self.keys.tolist()] + [self.NONE], np.int64)
        self.keys = np.append(self.keys, np.iinfo(np.int64).max)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], self.NONE)


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): the token ids of all words in a row, and where each word's ids end.

    A merged token's id is its rank. ``pair`` holds the rank of the pair that
    starts at a position; positions swallowed by a merge hold ``NONE``.
    """
    none = merges.NONE
    lengths = np.array([len(w) for w in words], np.int64)
    size = int(lengths.sum())
    if not size:
        return np.empty(0, np.int64), np.cumsum(lengths)
    token = merges.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    nxt, prv = np.arange(1, size + 1), np.arange(-1, size - 1)
    nxt[ends[lengths > 0] - 1] = -1
    prv[(ends - lengths)[lengths > 0]] = -1
    alive = np.ones(size, bool)
    pair = np.full(size, none)
    inner = np.flatnonzero(nxt >= 0)
    pair[inner] = merges.rank(token[inner], token[inner + 1])

    # The inverted index: pair rank -> positions, where the pair stands now or stood before.
    index: dict[int, list[int]] = {}
    order = np.argsort(pair, kind="stable")
    order = order[pair[order] < none]
    cuts = np.flatnonzero(np.diff(pair[order])) + 1
    for part in np.split(order, cuts) if len(order) else []:
        index[int(pair[part[0]])] = part.tolist()
    heap = list(index)
    heapq.heapify(heap)

    def note(ranks: np.ndarray, positions: np.ndarray) -> None:
        for q, i in zip(ranks.tolist(), positions.tolist(), strict=True):
            if q < none:
                if q in index:
                    index[q].append(i)
                else:
                    index[q] = [i]
                    heapq.heappush(heap, q)

    while heap:
        r = heapq.heappop(heap)
        at = np.array(index.pop(r))
        at = at[pair[at] == r]
        if len(at) > 1:
            at = held = np.unique(at)
            touching = nxt[at[:-1]] == at[1:]
            if touching.any():  # "aaaa": of a run of overlapping pairs, every other one, from the left
                k = np.arange(len(at))
                first = np.maximum.accumulate(np.where(np.append(True, ~touching), k, 0))
                at = at[(k - first) % 2 == 0]
        if not len(at):
            continue
        while True:
            gone = nxt[at]
            after, before = nxt[gone], prv[at]
            right, left = np.full(len(at), none), np.full(len(at), none)
            has = after >= 0
            right[has] = merges.rank(np.full(int(has.sum()), r), token[after[has]])
            had = before >= 0
            # The token before may be merged in this very round.
            met = np.isin(before[had], gone) if len(at) > 1 else np.zeros(int(had.sum()), bool)
            left[had] = merges.rank(np.where(met, r, token[before[had]]), np.full(int(had.sum()), r))
            low = (right < r) | (left < r)
            if not low.any() or len(at) == 1:
                break
            # A merge makes a pair of lower rank: in such words only the leftmost merge is done now.
            slow = np.isin(word[at], word[at][low])
            lead = np.zeros(len(at), bool)
            lead[np.unique(word[at], return_index=True)[1]] = True
            if not (slow & ~lead).any():
                break
            # Their other pairs stay in the index, also those that overlap a merge put off here.
            later = np.setdiff1d(held[np.isin(word[held], word[at][low])], at[lead])
            note(np.full(len(later), r), later)
            at = at[~slow | lead]
        token[at] = r
        nxt[at] = after
        prv[after[has]] = at[has]
        pair[gone] = none
        alive[gone] = False
        # Neighbours merged in this round have their new tokens in place now.
        fresh = np.full(len(at), none)
        fresh[has] = merges.rank(np.full(int(has.sum()), r), token[after[has]])
        pair[at] = fresh
        note(fresh, at)
        if had.any():
            back = prv[at[had]]
            fresh = merges.rank(token[back], np.full(len(back), r))
            pair[back] = fresh
            note(fresh, back)
    at = np.flatnonzero(alive)
    return token[at], np.searchsorted(at, ends)


class Codec:
    """Encodes and decodes whole texts; words seen before come from a bounded cache."""

    def __init__(self, rank_path: str, pattern: str):
        ranks = read_ranks(rank_path)
        self.merges = Merges(ranks)
        self.find = regex.compile(pattern).findall
        self.names = {v: k for k, v in ranks.items()}
        self.whole = {k: np.array([v], "<u4").tobytes() for k, v in ranks.items()}
        self.cache: dict[str, bytes] = {}

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        parts = [self.find(t) for t in texts]
        new = set().union(*parts).difference(self.cache)
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = set().union(*parts)
        for w in new:
            whole = self.whole.get(w.encode())
            if whole is not None:
                self.cache[w] = whole
        new = sorted(new.difference(self.cache))
        ids, ends = replay([w.encode() for w in new], self.merges)
        raw, begin = ids.astype("<u4").tobytes(), 0
        for w, end in zip(new, (ends * 4).tolist(), strict=True):
            self.cache[w] = raw[begin:end]
            begin = end
        get = self.cache.__getitem__
        for p in parts:
            yield b"".join(map(get, p))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def codec(rank_path: str, pattern: str) -> Codec:
    """The codec of a vocabulary and pattern, kept for the next task of this worker process.

    Functions shipped by value bring new module globals with every task: what is kept is kept
    under a module name of its own. Its words stay bounded by ``CACHE_WORDS``.
    """
    store = sys.modules.setdefault("_revtrace_codecs", ModuleType("_revtrace_codecs")).__dict__
    key = f"{rank_path}\0{pattern}"
    if key not in store:
        store[key] = Codec(rank_path, pattern)
    return store[key]


def _groups(texts: list[str], limit: int = 8_000_000) -> Iterator[list[str]]:
    """Runs of texts of about ``limit`` characters: each is one corpus of the replay."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > limit:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def encode_documents(
    df: DataFrame,
    rank_path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """One row per input row: id, n_tokens, [token_ids array], ids_sha256, decoded_sha256, round_trip.

    ``decoded_sha256`` hashes the bytes that decoding the ids gives, and
    ``round_trip`` tells whether they are the text's own. Without ``keep_ids``
    the ids themselves are left out.
    """
    arrow_rows(df.sparkSession)
    fields = [
        T.StructField(id_col, df.schema[id_col].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("token_ids", T.ArrayType(T.IntegerType())),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        T.StructField("round_trip", T.BooleanType()),
    ]
    if not keep_ids:
        del fields[2]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(rank_path, pattern)
        for batch in batches:
            done, texts = 0, batch.column(1).to_pylist()
            for group in _groups(texts):
                n, lists, ids_sha, dec_sha, same = [], [], [], [], []
                for text, ids in zip(group, known.encode(group), strict=True):
                    raw = known.decode(ids)
                    n.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    dec_sha.append(hashlib.sha256(raw).hexdigest())
                    same.append(raw == text.encode())
                    if keep_ids:
                        lists.append(np.frombuffer(ids, "<i4"))
                columns = [batch.column(0).slice(done, len(group)), pa.array(n, pa.int64())]
                if keep_ids:
                    columns.append(pa.array(lists, pa.list_(pa.int32())))
                columns += [pa.array(ids_sha), pa.array(dec_sha), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])
                done += len(group)

    rows = df.select(F.col(f"`{id_col}`").alias("_id"), text_of(text_col).alias("_text"))
    return rows.mapInArrow(encode, T.StructType(fields))
