"""Exact, near, substring and suffix deduplication against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revtrace.llm import exact_dedup, near_dup, segments, substring_dedup, suffix_dedup
from revtrace.llm.common import BLOOM

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def documents(df):
    """The distinct (id, text) in document order, with Spark's hash of the text as the second key."""
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).select("doc_id", "t", F.xxhash64("t").alias("x")).collect()
    return sorted({tuple(r) for r in rows}, key=lambda r: (r[0] is not None, r[0] or 0, r[2]))


def check(df, got, columns, expected):
    a = Counter(tuple(r[c] for c in ["doc_id", *columns]) for r in got.collect())
    b = Counter((r.doc_id, *expected[r.doc_id, r.text or ""]) for r in df.select("doc_id", "text").collect())
    assert a == b


# -- exact


def exact_by_hand(df):
    groups = {}
    for r in df.select("doc_id", "text").collect():
        groups.setdefault((r.text or "").translate(FOLD), []).append(r.doc_id)
    out = {}
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        for i in ids:
            out[i, t] = (keep, len(ids), i == keep, sha)
    return out


EXACT = ["keep_id", "group_size", "kept", "text_sha256"]


@pytest.fixture(scope="module")
def copies(odd):
    random.seed(1)
    return odd([random.choice(["Same Text", "same text", "SAME tExt", "Ärger", "ärger", "one", "two"]) for _ in range(80)])


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.substring(t, 1, 2)], ids=["sha256", "colliding"])
def test_exact(copies, digest):
    by_text = exact_by_hand(copies)
    got = exact_dedup.exact_dedup(copies, digest=digest, salts=3)
    a = Counter(tuple(r[c] for c in ["doc_id", *EXACT]) for r in got.collect())
    b = Counter((r.doc_id, *by_text[r.doc_id, (r.text or "").translate(FOLD)]) for r in copies.collect())
    assert a == b


def test_exact_keep_one(copies):
    got = exact_dedup.keep_one(copies)
    assert got.columns == copies.columns
    texts = [(r.text or "").translate(FOLD) for r in got.collect()]
    assert sorted(texts) == sorted({(r.text or "").translate(FOLD) for r in copies.collect()})
    assert got.select("_digest").distinct().collect() == [("_digest",)]


def test_exact_native(copies):
    plan = exact_dedup.exact_dedup(copies)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_exact_moves_no_text(copies, monkeypatch):
    """Digests and counts are shuffled; the texts are not."""
    kept, plans = exact_dedup.materialize, []

    def written(frame, purpose):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return kept(frame, purpose)

    monkeypatch.setattr(exact_dedup, "materialize", written)
    exact_dedup.exact_dedup(copies)
    assert len(plans) == 1 and "HashAggregate(keys=[_digest" in plans[0]
    assert not re.search(r"(keys=|hashpartitioning)[^\])]*_norm", plans[0]), plans[0]


def test_exact_compares_whole_texts(spark, monkeypatch):
    """Two texts of one digest, one length and one xxHash are two groups: only their content tells them apart."""
    monkeypatch.setattr(exact_dedup, "sha256", lambda t: F.length(t).cast("string"))
    a, b = "the same text as", "xrcebyfki}8_zf>x"
    df = spark.createDataFrame([(1, a), (2, b), (3, a.upper()), (4, b), (5, "alone")], "doc_id long, text string")
    assert df.where("doc_id < 3").select(F.xxhash64("text")).distinct().count() == 1
    got = exact_dedup.exact_dedup(df, digest=exact_dedup.sha256)
    assert sorted(got.select("doc_id", "keep_id", "group_size").collect()) == [(1, 3, 2), (2, 4, 2), (3, 3, 2), (4, 4, 2), (5, 5, 1)]


def test_exact_keep_one_compares_whole_texts(spark, monkeypatch):
    """The pipeline's stage keeps a row of each text, also of texts that share digest, length and xxHash."""
    monkeypatch.setattr(exact_dedup, "sha256", lambda t: F.length(t).cast("string"))
    monkeypatch.setattr(exact_dedup.exact_dedup, "__defaults__", (*exact_dedup.exact_dedup.__defaults__[:-1], exact_dedup.sha256))
    a, b = "the same text as", "xrcebyfki}8_zf>x"
    df = spark.createDataFrame([(1, a), (2, b), (3, a.upper()), (4, b), (5, "alone")], "doc_id long, text string")
    assert sorted(exact_dedup.keep_one(df).collect()) == [(3, a.upper()), (4, b), (5, "alone")]


def test_exact_compares_only_repeated_digests(copies, no_broadcast, monkeypatch):
    """Texts whose digest comes once are not shuffled; copies are combined by their task and under a salt first."""
    monkeypatch.setitem(BLOOM, "applicationSideScanSizeThreshold", "0")
    stored, plans, several = exact_dedup.materialize(copies, "test-texts"), [], exact_dedup._several

    def compared(texts):
        query = texts._jdf.queryExecution()
        plans.append((query.optimizedPlan().toString(), query.executedPlan().toString()))
        return several(texts)

    monkeypatch.setattr(exact_dedup, "_several", compared)
    exact_dedup.exact_dedup(stored)
    assert len(plans) == 1 and "might_contain" in plans[0][0], plans
    assert re.search(r"hashpartitioning\(_digest[^)]*pmod[^)]*_norm|hashpartitioning\(_digest[^)]*_groupingexpression[^)]*_norm", plans[0][1]), plans


# -- near


def near_by_hand(df):
    sets = {}
    for i, t, x in documents(df):
        w = WORD.findall(t.translate(FOLD))
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets[i, t] = s
    top = {d: d for d in sets}

    def find(d):
        while top[d] != d:
            d = top[d]
        return d

    items = list(sets.items())
    for k, (a, s) in enumerate(items):
        for b, u in items[:k]:
            if s and u and 100 * len(s & u) >= 75 * len(s | u):
                top[find(a)] = find(b)
    least = {}
    for d in sets:
        least.setdefault(find(d), []).append(d[0])
    out = {}
    for d, s in sets.items():
        c = min((i for i in least[find(d)] if i is not None), default=None)
        out[d] = (len(s), c if s else d[0], d[0] == (c if s else d[0]))
    return out


@pytest.fixture(scope="module")
def near_copies(odd):
    """Chains of copies, copies of one base, unrelated texts, short ones and copies."""
    random.seed(2)
    vocabulary = [f"w{k}" for k in range(500)]
    texts = []
    for _ in range(6):
        base = random.choices(vocabulary, k=random.randint(30, 120))
        for _ in range(8):
            changed = list(base)
            changed[random.randrange(len(base))] = random.choice(vocabulary)
            texts.append(" ".join(changed))
            if random.random() < 0.5:
                base = changed
    texts += [" ".join(random.choices(vocabulary, k=n)) for n in (1, 2, 4, 5, 6, 60, 61)] * 2
    return odd([t.title() if k % 3 else t for k, t in enumerate(texts)])


def test_near(near_copies):
    check(near_copies, near_dup.near_dedup(near_copies), ["n_shingles", "component_id", "kept"], near_by_hand(near_copies))


def test_near_rounds_lose_no_link(near_copies, monkeypatch):
    """With every comparison left to further star rounds the components are the same."""
    monkeypatch.setattr(near_dup, "PAIRS_PER_DOCUMENT", 0)
    check(near_copies, near_dup.near_dedup(near_copies), ["n_shingles", "component_id", "kept"], near_by_hand(near_copies))


def test_near_keep_one(near_copies):
    got = near_dup.keep_one(near_copies)
    assert got.columns == near_copies.columns
    groups = Counter()
    by_hand = near_by_hand(near_copies)
    for d in {(r.doc_id, r.text or "") for r in got.collect()}:
        groups[by_hand[d][1] if by_hand[d][0] else d] += 1
    assert set(groups.values()) == {1}
    assert len(groups) == len({v[1] if v[0] else d for d, v in by_hand.items()})


def test_near_copies_that_do_not_link_make_few_pairs(spark, monkeypatch):
    """Copies with edits of their own, too far from each other: the reach bound rules pairs out, and changes no result."""
    random.seed(11)
    vocabulary = [f"w{k}" for k in range(5000)]
    base = random.choices(vocabulary, k=200)
    rows = []
    for k in range(160):
        changed = list(base)
        for at in random.sample(range(200), 8 if k else 0):
            changed[at] = random.choice(vocabulary)
        rows.append((k, " ".join(changed[: 200 - k % 3 * 5])))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_id", F.lit(1))
    kept, pairs = near_dup.materialize, []

    def written(frame, purpose):
        out = kept(frame, purpose)
        if purpose == "near-dup-alike":
            pairs.append(out.count())
        return out

    monkeypatch.setattr(near_dup, "materialize", written)
    check(df, near_dup.near_dedup(df), ["n_shingles", "component_id", "kept"], near_by_hand(df))
    assert sum(pairs[1:]) < 160  # of 12,720


def test_near_reads_the_texts_once(near_copies, no_broadcast, monkeypatch):
    """However many rounds: full sets are taken once, from texts that pass a Bloom filter before they are shuffled."""
    monkeypatch.setattr(near_dup, "PAIRS_PER_DOCUMENT", 0)
    monkeypatch.setitem(near_dup.BLOOM, "applicationSideScanSizeThreshold", "0")
    stored = near_dup.materialize(near_copies, "test-texts")
    kept, plans = near_dup.materialize, []

    def written(frame, purpose):
        if purpose == "near-dup-sets":
            plans.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return kept(frame, purpose)

    monkeypatch.setattr(near_dup, "materialize", written)
    check(near_copies, near_dup.near_dedup(stored), ["n_shingles", "component_id", "kept"], near_by_hand(near_copies))
    assert len(plans) == 1 and "might_contain" in plans[0], plans
    assert no_broadcast.conf.get("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold") != "0"


def test_near_small_sets(spark):
    """Sets of up to two dozen shingles have an exact path: every link is found."""
    random.seed(12)
    vocabulary = [f"w{k}" for k in range(2000)]
    rows = []
    for _ in range(150):
        base = random.choices(vocabulary, k=random.randint(5, 28))
        rows.append(" ".join(base))
        for _ in range(3):
            longer = base + random.choices(vocabulary, k=random.randint(0, 6))
            rows.append(" ".join(longer[random.randint(0, 2) :]))
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn("_id", F.lit(1))
    check(df, near_dup.near_dedup(df), ["n_shingles", "component_id", "kept"], near_by_hand(df))


def test_signature_estimates_similarity():
    import numpy as np

    rng = np.random.default_rng(0)
    agree = []
    for _ in range(60):
        x = np.unique(rng.integers(0, 1 << 63, 140, np.int64).astype(np.uint64) * 2)
        agree.append((near_dup.signature(x[:-20]) == near_dup.signature(x[20:])).mean())
    assert abs(sum(agree) / 60 - 100 / 140) < 0.03


# -- substring


@pytest.fixture(scope="module")
def passages(odd):
    random.seed(3)
    base = [random.choice([f"w{k}" for k in range(300)]) for _ in range(60)]
    texts = []
    for _ in range(90):
        r = random.random()
        if r < 0.25:
            w = ["De"] * random.randint(0, 80)
        elif r < 0.5:
            w = [random.choice("abcd") for _ in range(random.randint(0, 60))]
        elif r < 0.8:
            w = [f"x{random.randint(0, 9)}" for _ in range(random.randint(0, 9))] + base[: random.randint(20, 60)] + ["end"]
        else:
            w = (["p", "q", "r", "s", "t"] * 20)[: random.randint(15, 90)]
        texts.append(random.choice([" ", "\n", " \t "]).join(w))
    return odd(texts, [(7, "a b c"), (None, " ".join(base))])


def substring_by_hand(df):
    seen, out = set(), {}
    for i, t, _ in documents(df):
        w = WORD.findall(t)
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            k = tuple(w[j : j + 20])
            if k in seen:
                gone[j : j + 20] = [True] * 20
            seen.add(k)
        kept = " ".join(a for a, g in zip(w, gone, strict=True) if not g)
        out[i, t] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [50_000, 3])
def test_substring(passages, monkeypatch, hot):
    monkeypatch.setattr(segments, "HOT", hot)
    got = substring_dedup.substring_dedup(passages)
    check(passages, got, ["n_words", "n_removed", "kept_sha256"], substring_by_hand(passages))


# -- suffix


@pytest.fixture(scope="module")
def strings(odd):
    random.seed(4)
    shared = ["".join(random.choice("abcdefgh \né") for _ in range(n)) for n in (399, 400, 401, 900)]
    noise = lambda: "".join(random.choice("xyz") for _ in range(random.randint(0, 200)))
    texts = ["De " * random.randint(0, 300) for _ in range(8)] + ["a" * random.randint(0, 700) for _ in range(8)]
    texts += [noise() + random.choice(shared) + noise() + random.choice([*shared, ""]) for _ in range(25)]
    texts += [noise() for _ in range(8)] + ["a b c\x00" * 150]
    return odd(texts)


def suffix_by_hand(df):
    found, out = Counter(), {}
    docs = documents(df)
    for _, t, _ in docs:
        b = t.encode()
        found.update(b[k : k + 400] for k in range(len(b) - 399))
    for i, t, _ in docs:
        b, gone = t.encode(), bytearray(len(t.encode()))
        for k in range(len(b) - 399):
            if found[b[k : k + 400]] > 1:
                gone[k : k + 400] = b"\x01" * 400
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i, t] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [50_000, 3])
def test_suffix(strings, monkeypatch, hot):
    monkeypatch.setattr(segments, "HOT", hot)
    strings = strings.where("doc_id IS NULL OR doc_id <> 503")  # a repeated word of 45,000 bytes is slow by hand
    got = suffix_dedup.suffix_dedup(strings)
    check(strings, got, ["n_bytes", "n_removed", "n_spans", "kept_sha256"], suffix_by_hand(strings))


@pytest.mark.parametrize("budget", [0, 64, 1 << 20])
def test_induced_sort(budget):
    import numpy as np

    from revtrace.llm.induced_sort import suffixes

    random.seed(5)
    for _ in range(80):
        text = [random.randint(0, random.choice([1, 2, 5])) for _ in range(random.randint(1, 50))]
        clip = random.choice([3, 8, 64])
        got = [(int(p), int(k)) for ps, ks in suffixes(np.array(text), clip, budget) for p, k in zip(ps, ks, strict=True)]
        assert sorted(p for p, _ in got) == list(range(len(text)))
        for (p, _), (q, k) in zip(got, got[1:], strict=False):
            a, b = text[p:], text[q:]
            common = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert a[:clip] >= b[:clip] and k == min(common, clip)


def test_fm_index_counts():
    import numpy as np

    from revtrace.llm.fm_index import FMIndex

    rng = np.random.default_rng(1)
    text = np.append(rng.integers(1, 6, 300), 0)
    index = FMIndex(text, 400)
    for _ in range(60):
        pattern = rng.integers(1, 6, rng.integers(1, 5))
        low, high = np.zeros(1, np.int64), np.full(1, len(text))
        for symbol in pattern[::-1]:
            low, high = index.extend(np.array([symbol]), low, high)
        n = sum((text[k : k + len(pattern)] == pattern).all() for k in range(len(text) - len(pattern)))
        assert high[0] - low[0] == n


def test_empty(none):
    assert exact_dedup.exact_dedup(none).collect() == exact_dedup.keep_one(none).collect() == []
    assert near_dup.near_dedup(none).collect() == near_dup.keep_one(none).collect() == []
    assert substring_dedup.substring_dedup(none).collect() == suffix_dedup.suffix_dedup(none).collect() == []
