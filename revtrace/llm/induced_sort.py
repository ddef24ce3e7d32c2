"""External induced sorting of suffixes with common-prefix values.

The suffixes that begin a rising run (left-most S, "LMS") are sorted first; all
others are induced from them: one scan in ascending order induces the falling
(L) suffixes, one in descending order the rising (S) suffixes. Between induction
and scan, suffixes wait as tuples (position, common prefix) in a priority queue
over their first symbol. Suffixes of one symbol are induced in order, so
the queue keeps one first-in-first-out list per symbol; lists beyond the memory
budget go to an unlinked scratch file of the task and are read back block by block.

Common-prefix values travel with the tuples: an induced suffix shares one symbol
more with its neighbour than the suffixes that induced both, whose value is the minimum
over the part of the scan between them. Where falling meets rising suffixes of one
symbol, the value is the shorter of their runs of that symbol.

All steps work on whole blocks of a list at once (numpy). Values are clipped at
``clip``; the order is right for prefixes of that length.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

from revtrace.llm.fm_index import suffix_order
from revtrace.llm.words import inverse, mix, powers

_HASH = np.uint64(0x8EBC6AF09C88C6E3)
_FAR = np.int32(1 << 30)


class Queue:
    """First-in-first-out lists of (position, common prefix) per symbol, on disk beyond ``budget`` bytes."""

    def __init__(self, symbols: int, budget: int):
        self.lists: list[list] = [[] for _ in range(symbols)]
        self.budget, self.held, self.file = budget, 0, None

    def push(self, symbol: int, position: np.ndarray, prefix: np.ndarray) -> None:
        block = np.empty((2, len(position)), np.int32)
        block[0], block[1] = position, prefix
        if self.held + block.nbytes > self.budget:
            if self.file is None:
                self.file = tempfile.TemporaryFile()  # noqa: SIM115  unlinked; closed with the queue
            self.file.seek(0, 2)
            self.lists[symbol].append((self.file.tell(), len(position)))
            self.file.write(block.tobytes())
        else:
            self.held += block.nbytes
            self.lists[symbol].append(block)

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All that waits for a symbol, in order; None if nothing does."""
        waiting, self.lists[symbol] = self.lists[symbol], []
        if not waiting:
            return None
        blocks = []
        for b in waiting:
            if isinstance(b, tuple):
                self.file.seek(b[0])
                b = np.frombuffer(self.file.read(8 * b[1]), np.int32).reshape(2, -1)
            else:
                self.held -= b.nbytes
            blocks.append(b)
        both = blocks[0] if len(blocks) == 1 else np.concatenate(blocks, axis=1)
        return both[0], both[1]

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class _Scan:
    """One direction of inducing: deals the scanned suffixes' predecessors to the lists of their symbols."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, symbols: int, clip: int, queue: Queue):
        self.text, self.wanted, self.clip, self.queue = text, wanted, clip, queue
        self.least = np.full(symbols, -1, np.int32)  # since a list's last item; -1: none yet

    def induce(self, position: np.ndarray, prefix: np.ndarray) -> None:
        """``prefix``: of each suffix with the one scanned before it."""
        before = position - 1
        take = np.flatnonzero((before >= 0) & self.wanted[before])
        # prefix values of the scan, with a value at the end that never is the minimum
        row = np.append(prefix, _FAR)
        whole = int(prefix.min())
        if not len(take):
            np.minimum(self.least, whole, out=self.least)
            return
        symbol = self.text[before[take]]
        order = np.argsort(symbol, kind="stable")
        at, symbol = take[order], symbol[order]
        new = np.append(True, symbol[1:] != symbol[:-1])
        first = np.flatnonzero(new)
        begin = np.append(0, at[:-1] + 1)
        begin[first] = 0
        between = np.minimum.reduceat(row, np.stack((begin, at + 1), 1).ravel())[::2]
        heads, last = symbol[first], np.append(first[1:], len(at)) - 1
        carried = self.least[heads]
        value = np.minimum(between, self.clip - 1) + 1
        value[first] = np.where(carried < 0, 0, np.minimum(np.minimum(between[first], carried), self.clip - 1) + 1)
        for s, a, b in zip(heads.tolist(), first.tolist(), (last + 1).tolist(), strict=True):
            self.queue.push(s, before[at[a:b]], value[a:b])
        np.minimum(self.least, whole, out=self.least)
        tail = np.stack((at[last] + 1, np.full(len(last), len(row) - 1)), 1).ravel()
        self.least[heads] = np.minimum.reduceat(row, tail)[::2]


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, clip: int) -> np.ndarray:
    """The common prefixes of suffixes a and b, clipped, by hashes of falling powers of two."""
    n = len(text)
    inv = powers(inverse(_HASH), n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * powers(_HASH, n), out=total[1:])
    found = np.zeros(len(a), np.int64)
    step = 1 << (clip.bit_length() - 1)
    while step:
        x, y = a + found, b + found
        fits = np.flatnonzero((x + step <= n) & (y + step <= n))
        x, y = x[fits], y[fits]
        equal = (total[x + step] - total[x]) * inv[x] == (total[y + step] - total[y]) * inv[y]
        found[fits[equal]] += step
        step >>= 1
    return np.minimum(found, clip).astype(np.int32)


def _names(text: np.ndarray, rising: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Names, in order, of the substrings from each LMS position to the next (inclusive)."""
    ends = np.append(lms[1:], lms[-1])
    letters = (text.astype(np.uint64) << np.uint64(1)) + rising + np.uint64(2)
    bits, per = np.uint64(11), 5
    name = np.zeros(len(lms), np.int64)
    todo, done = np.arange(len(lms)), 0
    while len(todo):
        word = np.zeros(len(todo), np.uint64)
        for k in range(per):
            at = lms[todo] + done + k
            inside = at <= ends[todo]
            word = word << bits | np.where(inside, letters[np.where(inside, at, 0)], 0)
        order = np.lexsort((word, name[todo]))
        group, w = name[todo][order], word[order]
        new = np.append(True, (group[1:] != group[:-1]) | (w[1:] != w[:-1]))
        # A name is the rank of the first of its equals, so refined names keep their places.
        head = np.append(True, group[1:] != group[:-1])
        place = np.arange(len(order))
        start = np.maximum.accumulate(np.where(head, place, 0))
        name[todo[order]] = group + np.maximum.accumulate(np.where(new, place, 0)) - start
        done += per
        same = np.ones(len(order), bool)
        same[1:] = ~new[1:]
        equal = same.copy()
        equal[0] = False
        equal[:-1] |= equal[1:]
        rest = todo[order][equal]
        todo = np.sort(rest[lms[rest] + done <= ends[rest]])
    return name


def suffixes(text: np.ndarray, clip: int, budget: int = 64 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (positions, common prefixes) of all suffixes of ``text`` in descending order.

    A prefix value is that with the suffix given just before. ``text`` holds
    small non-negative integers, at most 1000 different ones.
    """
    n = len(text)
    if not n:
        return
    t = np.append(text.astype(np.int16) + 1, np.int16(0))  # a unique smallest end
    symbols = int(t.max()) + 1
    change = np.append(t[1:] != t[:-1], True)
    turn = np.minimum.accumulate(np.where(change, np.arange(n + 1, dtype=np.int32), n)[::-1])[::-1]
    rising = np.append(t[turn[:-1]] < t[np.minimum(turn[:-1] + 1, n)], True)
    run = turn - np.arange(n + 1, dtype=np.int32) + 1
    lms = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1

    # The reduced string: its suffixes' order is that of the LMS suffixes.
    order = suffix_order(_names(t, rising, lms), clip // 2 + 1)
    seeds = lms[order].astype(np.int32)
    shared = np.zeros(len(seeds), np.int32)
    shared[1:] = _common(t, seeds[:-1].astype(np.int64), seeds[1:].astype(np.int64), clip)
    cut = np.searchsorted(t[seeds], np.arange(symbols + 1))

    store = Queue(symbols, budget)
    queue = Queue(symbols, budget)
    scan = _Scan(t, ~rising, symbols, clip, queue)
    for c in range(symbols):
        last = -1
        while (got := queue.pop(c)) is not None:
            position, prefix = got
            store.push(c, position, prefix)
            last = int(position[-1])
            scan.induce(position, prefix)
        position, prefix = seeds[cut[c] : cut[c + 1]], shared[cut[c] : cut[c + 1]].copy()
        if len(position):
            prefix[0] = min(run[last], run[position[0]], clip) if last >= 0 else 0
            scan.induce(position, prefix)
    queue.close()

    queue = Queue(symbols, budget)
    scan = _Scan(t, rising, symbols, clip, queue)
    for c in range(symbols - 1, 0, -1):
        last = -1
        while (got := queue.pop(c)) is not None:
            position, prefix = got
            yield position, prefix
            last = int(position[-1])
            scan.induce(position, prefix)
        got = store.pop(c)
        if got is not None:
            position, up = got[0][::-1], got[1][::-1]
            prefix = np.append(np.int32(0), up[:-1]).astype(np.int32)
            if last >= 0:
                prefix[0] = min(run[last], run[position[0]], clip)
            yield position, prefix
            scan.induce(position, prefix)
    queue.close()
    store.close()
