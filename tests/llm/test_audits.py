"""op11 to op13: URL filter, spelling variants, source divergence, against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revtrace.llm import divergence, spelling, url_filter
from revtrace.operators.graph import components

LATIN = "[A-Za-zÀ-ÿ]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def clash(df, *more):
    names = ["_id", "_host", "_path", "_node", "_text", "_lang", "_key", "_n", "word", "n", "verdict", "rank", "_url", *more]
    return df.select("*", *[F.lit(x).alias(x) for x in names if x not in df.columns])


# -- op11


def canonical(to):
    return f"<html><head><link rel='canonical' href='{to}'></head></html>"


def refresh(to):
    return f'<META HTTP-EQUIV="Refresh" CONTENT="0; URL={to}">'


def judge(spark, rows, **more):
    df = clash(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r.page_id: r for r in url_filter.filter_urls(df, **more).collect()}


def test_rules_alone(spark):
    urls = {
        1: ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
        2: ("https://example.net/EN/x", "example.net", "/EN/x", "net/", "block"),
        3: ("http://badexample.net", "badexample.net", "", None, "allow"),
        4: ("http://xnet/", "xnet", "/", None, "allow"),
        5: ("ftp://www.example.com/de/", "www.example.com", "/de/", "example.com/de/", "block"),
        6: ("http://example.com/de", "example.com", "/de", None, "allow"),
        7: ("http://x.org/fr/a://b", "x.org", "/fr/a://b", "org/fr/", "allow"),
        8: ("no scheme", "", "", None, "allow"),
        9: (None, "", "", None, "allow"),
        10: ("", "", "", None, "allow"),
        11: ("a\nb://Ex.NET?x/y", "ex.net", "", None, "allow"),
        12: ("://net/", "net", "/", "net/", "block"),
    }
    got = judge(spark, [(k, u[0], None) for k, u in urls.items()] + [(None, urls[1][0], ""), (1, urls[1][0], None)])
    for k, (_, *want) in urls.items():
        assert [got[k].host, got[k].path, got[k].rule, got[k].verdict] == want, k
    assert got[None].verdict == "allow" and got[None].host == "a.example.net"
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_filter.filter_urls(empty).collect() == []


def test_blocks_reach_aliases_and_allow_outranks(spark):
    rows = [
        (1, "http://a.com/1", canonical("https://a.com/2#top")),  # chain of aliases to a blocked target outside the table
        (2, "http://a.com/2", refresh("/3?x=1&amp;y=2")),
        (3, "https://A.com/3?x=1&y=2", canonical("http://spam.net/z")),
        (4, "http://b.com/1", canonical("//b.com/2")),  # class with both: allowed
        (5, "http://b.com/2", refresh("http://spam.net/w")),
        (6, "http://c.com/x/1", "<link href=other rel='alternate canonical'>"),
        (7, "http://c.com/x/other", canonical("http://b.org/fr/1")),
        (8, "http://spam.net/w", canonical("http://x.org/fr/ok")),  # own rule stays
        (9, "http://d.com/1", "<!-- " + canonical("http://spam.net/q") + "--><script>" + canonical("http://spam.net/q") + "</script>"),
        (10, "http://e.com/1", "<link rel='stylesheet' href='http://spam.net/q'><a rel=canonical href='http://spam.net/q'>"),
        (11, "http://f.com/1", canonical("http://f.com/1#a") + canonical("") + canonical("mailto:x@spam.net")),
        (12, "http://g.com", canonical("?p")),
        (13, "http://g.com/?p", canonical("http://spam.net/g")),
        (14, "http://a.com/1?", None),
    ]
    got = judge(spark, rows + rows[:1])
    assert {k: r.verdict for k, r in got.items()} == {
        1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "block",
        9: "allow", 10: "allow", 11: "allow", 12: "block", 13: "block", 14: "block",
    }
    assert {k for k, r in got.items() if r.by_alias} == {1, 2, 3, 12, 13, 14} and got[8].rule == "net/"
    log = spark.createDataFrame([("http://f.com/1", "http://spam.net/"), (None, "http://spam.net/"), ("http://e.com/1", None)], "from_url string, to_url string")
    assert judge(spark, rows, redirects=log)[11].verdict == "block"


def test_alias_classes_against_brute_force(spark):
    rng = random.Random(5)
    hosts = ["a.com", "b.org", "s.net", "example.net", "www.example.com"]
    url = lambda: f"http://{rng.choice(hosts)}/{rng.choice(['en', 'de', 'fr', 'x'])}/{rng.randrange(40)}"
    rows = [(k, url(), "".join(rng.choice([canonical, refresh])(url()) for _ in range(rng.choice([0, 0, 0, 1])))) for k in range(400)]
    rows += [(1000 + k, f"http://hub.com/{k}", canonical("http://hub.com/main")) for k in range(300)]  # a hub
    rule = lambda u: next((v for v, h, p in (("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"), ("block", "net", "/"))
                           if (u.split("/")[2] == h or u.split("/")[2].endswith("." + h)) and ("/" + u.split("/", 3)[3]).startswith(p)), None)
    top = {}

    def find(u):
        while top.setdefault(u, u) != u:
            u = top[u]
        return u

    for _, u, html in rows:
        for to in re.findall(r"http://[^'\">]*", html):
            top[find(u)] = find(to)
    said = {}
    for u in list(top):
        said.setdefault(find(u), set()).add(rule(u))
    got = judge(spark, rows)
    for k, u, _ in rows:
        all_ = said.get(find(u), set())
        assert got[k].verdict == (rule(u) or ("allow" if "allow" in all_ or "block" not in all_ else "block")), u


def test_sql_reads_links_alike(spark):
    duckdb = pytest.importorskip("duckdb")
    rows = [
        (1, "http://a.com/1", canonical("https://a.com/2#top")), (2, "http://a.com/2", refresh("/3?x=1&amp;y=2")), (3, "https://A.com/3?x=1&y=2", canonical("http://spam.net/z")),
        (4, "http://b.com/1", canonical("//b.com/2")), (5, "http://b.com/2", refresh("http://spam.net/w")), (6, "http://b.com/x/1", "<link href=../2 rel='alternate canonical'>"),
        (7, "http://g.com", canonical("?p")), (8, "http://g.com/?p", canonical("http://spam.net/g")), (9, None, canonical("x")), (10, "http://w.net/", None),
        (11, "http://b.com/2", canonical("http://y.org/fr/")), (12, "http://h.com/", "<!--" + canonical("http://spam.net/")),
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    cur = con.execute(url_filter.ORACLE_SQL)
    want = {r[0]: dict(zip([c[0] for c in cur.description], r)) for r in cur.fetchall()}
    assert {k: r.asDict() for k, r in judge(spark, rows).items()} == want
    assert sum(r["by_alias"] for r in want.values()) == 5


def test_components_on_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000), (6001, 6000)]
    got = {r._node: r._label for r in components(spark.createDataFrame(edges, "_a long, _b long")).collect()}
    assert got == {k: 0 for k in range(201)} | {k: 1000 for k in range(1000, 1400)} | {6000: 6000, 6001: 6000}
    assert components(spark.createDataFrame([], "_a long, _b long")).collect() == []


# -- op12


def edits(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute_words(docs, occurrences=5):
    n = Counter()
    for doc, text in docs:
        for run in re.findall(LATIN, text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= occurrences}


def brute_variants(docs):
    n = brute_words(docs)
    near = {w: [o for o in n if o != w and abs(len(o) - len(w)) < 2 and edits(w, o)] for w in n}
    form = {w: min(os, key=lambda o: (-n[o], o)) if os else None for w, os in near.items()}
    form = {w: f if f and n[f] >= 5 * n[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root(w)) for w in n}


def variants(spark, docs):
    df = clash(spark.createDataFrame(docs, "doc_id long, text string"))
    out = spelling.group_variants(df).collect()
    got = {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in out}
    assert len(got) == len(out)
    return got


def some_words(rng, size):
    words = ["".join(rng.choice("abÿéÀ") for _ in range(rng.choice([6, 7, 8, 15]))) for _ in range(size)]
    for w in list(words):  # deletions, replacements, insertions at all places
        k = rng.randrange(len(w))
        words += [w[:k] + w[k + 1 :], w[:k] + "z" + w[k + 1 :], w[:k] + "q" + w[k:], w[:k] + w[k] + w[k:]]
    return words


def test_variants_against_brute_force(spark):
    rng = random.Random(3)
    words = some_words(rng, 60)
    docs = [(k, " ".join(rng.choices(words, weights=[1 + 400 * (j % 17 == 0) for j in range(len(words))], k=60))) for k in range(400)]
    docs += [(None, None), (None, "Stone, STONES stoneS stones stones stones"), (7, ""), (8, "\u0130\u00d7 12 a_b"), *docs[:3]]
    long = "ab" * 3000
    docs += [(900 + k, f"{long} {long[:-1]} {long}x {long[:77]}y{long[78:]}") for k in range(6)]
    want = brute_variants(docs)
    assert variants(spark, docs) == want
    assert sum(w[2] is not None for w in want.values()) > 10 and max(w[1] for w in want.values()) > 2
    assert variants(spark, docs[:0]) == {} and variants(spark, [(1, None)]) == {}


def test_variants_in_blocks(spark, monkeypatch):
    """A hot prefix is cut into blocks; every pair is still found once."""
    rng = random.Random(4)
    words = sorted({"common" + w for w in some_words(rng, 40)} | set(some_words(rng, 20)))
    docs = [(k, " ".join(words + words[::9] * 3)) for k in range(5)]
    want = brute_variants(docs)
    monkeypatch.setattr(spelling, "BLOCK", 16)
    monkeypatch.setattr(spelling, "CELLS", 1000)
    monkeypatch.setattr(spelling, "STEP", 8)
    assert variants(spark, docs) == want


def test_near_pairs_kernel():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([7, 8]))) for _ in range(300)})
    for side in (0, 1):
        key = [w[:4] if side == 0 else w[-4:] for w in words]
        order = sorted(range(len(words)), key=lambda k: key[k])
        part, tile = [words[k] for k in order], np.array([sorted(set(key)).index(key[k]) for k in order])
        zero = np.zeros(len(part), int)
        x, y = spelling.near_pairs([w.encode() for w in part], 8, side, tile, zero, zero, zero)
        prefix = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        want = {
            (i, j) for i in range(len(part)) for j in range(i + 1, len(part))
            if tile[i] == tile[j] and max(len(part[i]), len(part[j])) == 8 and edits(part[i], part[j]) and (side == 0 or prefix(part[i], part[j]) < 4)
        }
        assert Counter(zip(x.tolist(), y.tolist())) == Counter(want)


# -- op13


def brute_audit(docs, documents=30, top=50):
    terms = lambda t: re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t.translate(FOLD))
    docs = [tuple(x or "" for x in d) for d in docs]
    out = set()
    for lang in {d[1] for d in docs}:
        own = [(t, s, Counter(terms(t))) for t, l, s in docs if l == lang]
        df = Counter(w for _, _, c in own for w in c)
        kept = sorted(w for w in df if df[w] >= documents)
        groups = {s: Counter() for _, s, _ in own}
        for _, s, c in own:
            groups[s].update(c)
        total = lambda c: sum(c[w] for w in kept)
        p = lambda c, n, w: 1 + 1_000_000_000 * (c[w] + 5) // (n + 5 * len(kept))
        every = sum(groups.values(), Counter())
        q = {w: p(every, total(every), w) for w in kept}
        ps = {s: {w: p(c, total(c), w) for w in kept} for s, c in groups.items()}
        for s in groups:
            pairs = [(o, sum(abs(ps[s][w] - ps[o][w]) for w in kept)) for o in groups if o != s]
            found = [(w, ps[s][w] - q[w]) for w in kept if groups[s][w] and ps[s][w] > q[w]]
            for part, rows, limit in (("pair", pairs, None), ("term", found, top)):
                for rank, (item, value) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0].encode()))[:limit], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


def audit(spark, docs, **more):
    df = clash(spark.createDataFrame(docs, "text string, lang string, source string"))
    rows = [tuple(r) for r in divergence.audit(df, **more).collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_audit_against_brute_force(spark):
    rng = random.Random(9)
    words = ["The", "the", "été", "Été", "naïve", "x1y2", "\u4e2d\u6587", "İ", "zebra", "z", *[f"w{chr(97 + k)}" for k in range(26)], *[f"rare{k}" for k in range(50)]]
    docs = []
    for k in range(700):
        lang = rng.choice(["en", "en", "fr", None, ""])
        source = rng.choice(["a", "a", "b", "c", None, "Z", "é"])
        docs.append((" ".join(rng.choices(words[: 10 + 3 * (k % 9)], k=rng.randrange(30))), lang, source))
    docs += docs[:5] * 60  # copies in one source
    docs += [(docs[7][0], "en", s) for s in "abcdefgh" for _ in range(5)]  # one text in many sources
    docs += [(None, "en", "a"), ("", "en", "only empty"), (None, None, None), ("alone", "xx", "s"), ("alone", "xx", "t"), ("one", "yy", "s")]
    docs += [("long " * 3000 + "\x00The|the{", "en", "b")]
    want = brute_audit(docs)
    assert audit(spark, docs) == want
    assert audit(spark, docs, documents=100, top=3) == brute_audit(docs, 100, 3)
    assert {r[5] for r in want if r[:3] == ("xx", "s", "pair")} == {1}
    assert audit(spark, docs[:0]) == set()


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_long_texts_are_cut_between_terms(monkeypatch, piece):
    monkeypatch.setattr(divergence, "PIECE", piece)
    text = "Ab été\u4e2d x\x7fAB ab" + "q" * 50 + " \n" + "ab" * 3
    assert divergence.text_terms(text) == Counter(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text.translate(FOLD)))
