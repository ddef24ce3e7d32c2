"""Texts in no learned language go, texts in one stay; the sample is bounded with copies."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revtrace.llm import langid

SMALL = "/root/testdata/sf0.01/documents.parquet"

OUTSIDE = [
    "det har ar en svensk text utan prickar som handlar om skogen och havet i norr dar vi bodde",
    "Ala ma kota a kot ma mleko i nie chce isc do domu bo pada deszcz",
    "xqz kwrt zzzk pfft wqqx bvvn jjkq mrrt lpwx zqqv xxkc",
    "これは日本語の文章です。東京は大きな町です。",
    "это русский текст о погоде и природе в нашей стране",
    "aGVsbG8gd29ybGQgdGhpcyBpcyBiYXNlNjQ9PQ QWxhZGRpbjpvcGVuIHNlc2FtZQ",
]
INSIDE = [
    "the cat sat on the mat and looked at the old house near the river",
    "THE CAT SAT ON THE MAT AND LOOKED AT THE OLD HOUSE NEAR THE RIVER!!",
    "el perro corre por la calle y la casa es grande",
    "der Hund und die Katze sind in dem alten Haus am Fluss",
    "le chat est sur la table et la maison est grande",
    "the total is 12345 67890 and 1234-5678 of the 99999 in the list",
    "of the",
    "a",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(SMALL)


@pytest.fixture(scope="module")
def model(docs):
    return langid.fit(docs)


def test_outside_texts_go_and_inside_ones_stay(spark, model):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(OUTSIDE + INSIDE)], "doc_id long, text string")
    kept = {r.doc_id for r in langid.keep_known(df, model).collect()}
    assert kept == set(range(len(OUTSIDE), len(OUTSIDE) + len(INSIDE)))
    everything = langid.keep_known(df, model, max_gap=100.0)
    assert everything.count() == len(OUTSIDE) + len(INSIDE)
    long = spark.createDataFrame([(1, INSIDE[0] * 20000), (2, OUTSIDE[0] * 20000)], "doc_id long, text string")
    assert [r.doc_id for r in langid.keep_known(long, model).collect()] == [1]


def test_clean_documents_stay(docs, model):
    """At least 98 % of the documents never learned from."""
    held = docs.where(langid.held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    assert langid.keep_known(held, model).count() >= 0.98 * held.count()


def test_gaps_equal_a_plain_computation(model, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [t.encode() for t in OUTSIDE + INSIDE] + [b"", b"1 2", bytes(rng.integers(0, 256, 500, np.uint8)), b"Za " * 400]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    def letter(b):
        return 97 <= b <= 122 or b >= 128

    want = []
    for t in texts:
        t = t.lower()  # bytes: A-Z only
        pairs = [(a, b) for a, b in zip(t, t[1:]) if (letter(a) and (letter(b) or b == 32)) or (a == 32 and letter(b))]
        if not pairs:
            want.append(0.0)
            continue
        means = [np.mean([bits[a * 256 + b] for a, b in pairs], dtype="f8") for bits in model.pairs]
        short = min(u - m for u, m in zip(model.usual, means))
        want.append(short / max(1, langid.TRAIN_BYTES / len(pairs)) ** 0.5)
    for piece in (1 << 20, 64, 7):
        monkeypatch.setattr(langid, "PIECE", piece)
        assert np.allclose(langid.gaps(model, data, offsets), want, atol=1e-4)


def test_copies_count_once_in_the_sample(spark):
    """A text that holds most rows is drawn at most once, whichever its hash is."""
    body = [f"word{chr(97 + k % 26)}{chr(97 + k // 26 % 26)} and some more letters to fill one window of bytes " * 4 for k in range(300)]
    rows = [(f"x{k}", t, "aa") for k, t in enumerate(body)] + [(f"y{j}{k}", body[k], "aa") for j in range(20) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    xs, ys = langid.sample_windows(df, 1000, 4, "doc_id", "text", "lang")
    assert 0 < len(xs) <= 4 * len(body)
    some, _ = langid.sample_windows(df, 30, 4, "doc_id", "text", "lang")
    assert 0 < len(some) <= 4 * 60
    assert set(Counter(ys)) == {"aa"}
