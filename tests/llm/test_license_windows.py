"""Licence passages with insertions, wherever they stand."""

import numpy as np

from revtrace.llm import license_scan
from revtrace.llm.words import Piece


def scan(library, *texts):
    """Per text its matches, positions counted from its start."""
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    piece = Piece(0, len(texts), np.frombuffer(b"".join(data), np.uint8), offsets)
    found = [[] for _ in texts]
    for d, name, a, b, share in library.matches(piece):
        found[d].append((name, a - int(offsets[d]), b - int(offsets[d]), share))
    return [license_scan._merged(x) for x in found]


def test_passages_with_insertions_do_not_depend_on_where_they_stand():
    words = [f"w{k}" for k in range(64)]  # 60 shingles, blocks of 64
    library = license_scan.Library([("L", " ".join(words))])
    spread = " ".join([*words[:32], *[f"header{k}" for k in range(80)], *words[32:]])
    for before in range(0, 200, 7):
        text = " ".join([f"x{k}" for k in range(before)] + [spread, "end"])
        alone = scan(library, text)[0]
        start = text.index("w0 ")
        assert [(n, a, b) for n, a, b, _ in alone] == [("L", start, start + len(spread))], before
        assert scan(library, "some words that stand before " * (before // 3), "", "few words", text, text)[-2:] == [alone, alone]


def test_whole_copies_stay_apart():
    words = " ".join(f"w{k}" for k in range(64))
    library = license_scan.Library([("L", words)])
    between = " ".join(f"x{k}" for k in range(150))
    got = scan(library, f"{words} {between} {words}")[0]
    assert [(a, b) for _, a, b, _ in got] == [(0, len(words)), (len(words) + len(between) + 2, 2 * len(words) + len(between) + 2)]
