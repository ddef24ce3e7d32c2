"""Language identification with a bidirectional gated recurrent network over bytes.

*Training* (driver, numpy): windows of ``TRAIN_BYTES`` bytes are cut from a
bounded sample of the labelled rows, and both directions are trained by
backpropagation through time with a label at every position. The sample holds
about ``per_lang`` distinct texts of each language, chosen by a hash of the text, so that copies count once;
``per_lang`` times the number of languages bounds what reaches the driver.

*Prediction* (executors): every byte of every text is read. A text is cut into
windows of ``WINDOW`` bytes; the network labels each position from all bytes of
its window, both directions, and the document's probabilities are the mean over
all its positions. Nothing but the text is an input. The model is about a
quarter of a megabyte per language and travels with the tasks; prediction needs no shuffle.

*Rejection* (:func:`keep_known`): the probabilities of the learned languages always add
up to one, so they cannot tell that a text is in none of them. The likelihood of its
letter pairs can: each language counts the byte pairs of half of its windows, the
other half shows what its texts usually reach, and a text whose pairs fall short of that
by more than ``MAX_GAP`` bits in every language is in none. Digits, marks and the
case of A-Z do not count, so code, numbers and shouting are no other language. A short text
can fall short by chance: the bits are divided by the root of ``TRAIN_BYTES`` over its pairs, so a
few words are given the benefit of the doubt.

Defined results: a null text, an empty one and one without any letter give
``und`` with score 0. Rows whose id is null are held out. With no labelled row
at all, every prediction is ``und``. Repeated rows get equal results, an empty
table an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrace.llm.common import arrow_rows
from revtrace.llm.words import buffers

HIDDEN = 12
WINDOW = 128
TRAIN_BYTES = 64
UNKNOWN = "und"
# Bits per letter pair. On the texts of sf0.1 the largest gap is 2.3; sentences of unlearned languages
# in the same letters begin at 3.4, chance letters at 7, other scripts at 14.
MAX_GAP = 3.0
PIECE = 1 << 20  # byte pairs looked up at once


@dataclass
class Direction:
    """One reading direction. Rows of all weights: update gate, reset gate, candidate."""

    enter: np.ndarray  # (3h, 256): what each byte adds, biases included
    again: np.ndarray  # (3h, h): what the state before adds
    leave: np.ndarray  # (languages, h)

    def parts(self) -> list[np.ndarray]:
        return [self.enter, self.again, self.leave]


@dataclass
class Model:
    langs: list[str]
    ahead: Direction
    back: Direction
    bias: np.ndarray  # (languages, 1)
    pairs: np.ndarray | None = None  # (languages, 65536): bits of each byte pair
    usual: np.ndarray | None = None  # (languages,): what texts of the language reach

    def parts(self) -> list[np.ndarray]:
        return [*self.ahead.parts(), *self.back.parts(), self.bias]


def new_model(langs: list[str], hidden: int, rng: np.random.Generator) -> Model:
    def one() -> Direction:
        return Direction(
            rng.normal(0, 0.3, (3 * hidden, 256)).astype("f4"),
            rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden)).astype("f4"),
            rng.normal(0, 1 / np.sqrt(hidden), (len(langs), hidden)).astype("f4"),
        )

    return Model(langs, one(), one(), np.zeros((len(langs), 1), "f4"))


def _run(d: Direction, x: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """All steps over x (time, batch): what the backward pass needs, and the logits (time, languages, batch)."""
    h = d.again.shape[1]
    state, steps, out = np.zeros((h, x.shape[1]), "f4"), [], []
    for row in x:
        a, u = d.enter[:, row], d.again @ state
        gates = 0.5 * np.tanh(0.5 * (a[: 2 * h] + u[: 2 * h])) + 0.5
        z, r = gates[:h], gates[h:]
        c = np.tanh(a[2 * h :] + r * u[2 * h :])
        steps.append((state, z, r, c, u[2 * h :]))
        state = c + z * (state - c)
        out.append(d.leave @ state)
    return steps, np.array(out)


def _gradients(d: Direction, x: np.ndarray, steps: list[tuple], delta: np.ndarray) -> list[np.ndarray]:
    """Backpropagation through time; delta is the loss gradient at the logits."""
    h = d.again.shape[1]
    again, leave = np.zeros_like(d.again), np.zeros_like(d.leave)
    inner = np.empty((len(x), 3 * h, x.shape[1]), "f4")
    carry = np.zeros((h, x.shape[1]), "f4")
    for t in range(len(x) - 1, -1, -1):
        before, z, r, c, u = steps[t]
        leave += delta[t] @ (c + z * (before - c)).T
        carry = carry + d.leave.T @ delta[t]
        dc = carry * (1 - z) * (1 - c * c)
        inner[t, :h] = carry * (before - c) * z * (1 - z)
        inner[t, h : 2 * h] = dc * u * r * (1 - r)
        inner[t, 2 * h :] = dc
        through = inner[t].copy()
        through[2 * h :] *= r
        again += through @ before.T
        carry = carry * z + d.again.T @ through
    flat, rows = x.ravel(), inner.transpose(1, 0, 2).reshape(3 * h, -1)
    enter = np.array([np.bincount(flat, row, 256) for row in rows]).astype("f4")
    return [enter, again, leave]


def train(windows: list[bytes], labels: list[str], steps: int = 260, batch: int = 160, seed: int = 7) -> Model:
    """Fit on windows of TRAIN_BYTES bytes; each language is drawn equally often."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    model = new_model(langs, HIDDEN, rng)
    x = np.frombuffer(b"".join(windows), np.uint8).reshape(-1, TRAIN_BYTES).astype(np.int64)
    y = np.searchsorted(langs, labels)
    of = [np.flatnonzero(y == k) for k in range(len(langs))]
    mean = [np.zeros_like(p) for p in model.parts()]
    square = [np.zeros_like(p) for p in model.parts()]
    for step in range(1, steps + 1):
        lang = rng.integers(len(langs), size=batch)
        pick = np.array([of[k][rng.integers(len(of[k]))] for k in lang])
        xs = x[pick].T
        one, ahead = _run(model.ahead, xs)
        two, back = _run(model.back, xs[::-1])
        logits = ahead + back[::-1] + model.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[:, lang, np.arange(batch)] -= 1
        delta = (p / p.shape[0] / batch).astype("f4")
        grads = _gradients(model.ahead, xs, one, delta) + _gradients(model.back, xs[::-1], two, delta[::-1])
        grads.append(delta.sum((0, 2))[:, None])
        scale = min(1.0, 1.0 / (float(np.sqrt(sum((g * g).sum() for g in grads))) + 1e-9))
        rate = 0.02 * (1 - step / (steps + 1)) + 0.001
        for w, g, m, s in zip(model.parts(), grads, mean, square, strict=True):  # Adam
            g = g * scale
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype("f4")
    return model


def _pair_tables() -> tuple[np.ndarray, np.ndarray]:
    """Bytes with A-Z folded, and which pairs count: letters or bytes of other scripts, at most one blank."""
    fold = np.arange(256)
    fold[65:91] += 32
    letter = np.zeros(256, bool)
    letter[97:123] = letter[128:] = True
    blank = np.arange(256) == 32
    counts = np.logical_and.outer(letter | blank, letter | blank) & np.logical_or.outer(letter, letter)
    return fold, counts.ravel()


FOLD, COUNTS = _pair_tables()


def _pair_means(pairs: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean bits of the counted pairs per language and text (languages, n), and how many count (n)."""
    n = len(offsets) - 1
    total, size = np.zeros((len(pairs), n)), np.zeros(n)
    for i in range(0, max(len(data) - 1, 0), PIECE):
        x = FOLD[data[i : i + PIECE + 1]]
        pair = x[:-1] * 256 + x[1:]
        at = np.arange(i, i + len(pair))
        text = np.searchsorted(offsets, at, "right") - 1
        use = COUNTS[pair] & (at + 1 < offsets[text + 1])  # both bytes in one text
        pair, text = pair[use], text[use]
        size += np.bincount(text, minlength=n)
        for k, bits in enumerate(pairs):
            total[k] += np.bincount(text, bits[pair], n)
    return total / np.maximum(size, 1), size


def profile(model: Model, windows: list[bytes], labels: list[str]) -> Model:
    """Letter pairs of each language: counted in every other window, the usual bits from the rest."""
    tables, usual = [], []
    for lang in model.langs:
        mine = [w for w, y in zip(windows, labels, strict=True) if y == lang]
        seen, rest = mine[::2], mine[1::2] or mine
        x = FOLD[np.frombuffer(b"".join(seen), np.uint8).reshape(-1, TRAIN_BYTES)]
        count = np.bincount((x[:, :-1] * 256 + x[:, 1:]).ravel(), minlength=65536).reshape(256, 256)
        single = (count.sum(0) + 0.5) / (count.sum() + 128)
        bits = np.log2((count + 4 * single) / (count.sum(1, keepdims=True) + 4)).astype("f4").reshape(1, -1)
        offsets = np.arange(len(rest) + 1) * TRAIN_BYTES
        mean, size = _pair_means(bits, np.frombuffer(b"".join(rest), np.uint8), offsets)
        enough = mean[0][size >= min(24, size.max())]
        tables.append(bits[0])
        usual.append(np.median(enough))
    model.pairs, model.usual = np.array(tables), np.array(usual)
    return model


def gaps(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text by how many bits a pair it falls short of the nearest language; 0 if nothing counts."""
    mean, size = _pair_means(model.pairs, data, offsets)
    short = (model.usual[:, None] - mean).min(0) / np.sqrt(np.maximum(1, TRAIN_BYTES / np.maximum(size, 1)))
    return np.where(size > 0, short, 0.0)


class Reader:
    """Labels every byte of many texts at once."""

    def __init__(self, model: Model, width: int = 2048):
        self.model, self.width = model, width
        h = model.ahead.again.shape[1]
        half = np.ones((3 * h, 1), "f4")
        half[: 2 * h] = 0.5  # sigmoid(a) = tanh(a / 2) / 2 + 1 / 2
        self.parts = [(d.enter * half, d.again * half, d.leave) for d in (model.ahead, model.back)]

    def _logits(self, side: int, x: np.ndarray, active: list[int], out: np.ndarray) -> None:
        """Add one direction's logits to out (time, languages, batch). Columns of x are by falling length."""
        enter, again, leave = self.parts[side]
        h = again.shape[1]
        state = np.zeros((h, x.shape[1]), "f4")
        for t in range(len(x)) if side == 0 else range(len(x) - 1, -1, -1):
            n = active[t]
            s = state[:, :n]
            a = enter.take(x[t, :n], 1)
            u = again @ s
            gates = u[: 2 * h]
            gates += a[: 2 * h]
            np.tanh(gates, gates)
            gates *= 0.5
            gates += 0.5
            c = u[2 * h :]
            c *= gates[h:]
            c += a[2 * h :]
            np.tanh(c, c)
            s -= c
            s *= gates[:h]
            s += c
            out[t, :, :n] += leave @ s

    def read(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text the summed probabilities of each language, and how many positions each language labels."""
        n, k = len(offsets) - 1, len(self.model.langs)
        lengths = np.diff(offsets)
        count = -(-lengths // WINDOW)
        text = np.repeat(np.arange(n), count)
        begin = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        begin = offsets[text] + begin * WINDOW
        size = np.minimum(WINDOW, offsets[text + 1] - begin)
        order = np.argsort(-size, kind="stable")
        sums, votes = np.zeros((n, k)), np.zeros((n, k))
        for i in range(0, len(order), self.width):
            rows = order[i : i + self.width]
            length = int(size[rows[0]])
            x = data[np.minimum(begin[rows] + np.arange(length)[:, None], len(data) - 1)]
            active = np.searchsorted(-size[rows], -np.arange(length), "left").tolist()
            p = np.empty((length, k, len(rows)), "f4")
            p[:] = self.model.bias
            self._logits(0, x, active, p)
            self._logits(1, x, active, p)
            live = np.arange(length)[:, None] < size[rows]
            top = p.max(1, keepdims=True)
            best = (p == top) & live[:, None]
            p -= top
            np.exp(p, p)
            p *= (live / p.sum(1))[:, None]
            where, total, first = text[rows], p.sum(0, dtype="f8"), best.sum(0)
            for j in range(k):
                sums[:, j] += np.bincount(where, total[j], n)
                votes[:, j] += np.bincount(where, first[j], n)
        return sums, votes


def held_out(id_col: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 1 modulo 3, or the id is null."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(3)) == 1, F.lit(True))


def sample_windows(
    df: DataFrame, per_lang: int, windows: int, id_col: str, text_col: str, lang_col: str
) -> tuple[list[bytes], list[str]]:
    """About ``per_lang`` distinct labelled texts of each language, ``windows`` windows from all over each."""
    rows = df.select(
        F.col(f"`{text_col}`").cast("string").alias("_text"), F.col(f"`{lang_col}`").cast("string").alias("_lang")
    ).where((F.col("_lang") != UNKNOWN) & ~held_out(F.col(f"`{id_col}`")) & F.col("_text").rlike(r"\p{L}"))
    draw = F.pmod(F.xxhash64(F.lit("lang sample"), "_text"), F.lit(1 << 30)) / float(1 << 30)
    texts = F.approx_count_distinct(F.xxhash64("_text"), 0.02)
    counts = rows.groupBy("_lang").agg(texts.alias("texts")).collect()
    share = F.create_map(*[F.lit(x) for r in counts for x in (r["_lang"], float(per_lang) / max(r["texts"], 1))]) if counts else None
    if share is None:
        return [], []
    start = (F.length("_text") / windows).cast("int")
    cut = F.array(*[F.substring("_text", start * k + 1, F.lit(TRAIN_BYTES)) for k in range(windows)])
    got = rows.where(draw < share[F.col("_lang")]).select("_lang", cut.alias("_cut")).distinct().collect()
    xs, ys = [], []
    for r in sorted(got, key=lambda r: (r["_lang"], r["_cut"])):
        for c in r["_cut"]:
            raw = c.encode()[:TRAIN_BYTES]
            if len(raw) >= TRAIN_BYTES // 2:
                xs.append((raw * 2)[:TRAIN_BYTES])
                ys.append(r["_lang"])
    return xs, ys


def fit(
    df: DataFrame,
    per_lang: int = 600,
    windows: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model | None:
    """Train on a bounded sample of the labelled rows that are not held out."""
    xs, ys = sample_windows(df, per_lang, windows, id_col, text_col, lang_col)
    return profile(train(xs, ys), xs, ys) if xs else None


def _label(model: Model | None, column: int):
    """A function giving each batch with lang_pred, score and agreement of its text column (empty: no letters)."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        reader = Reader(model) if model is not None else None
        for batch in batches:
            n = batch.num_rows
            offsets, data = buffers(batch.column(column))
            if reader is None or not n:
                yield batch, np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n)
                continue
            start = int(offsets[0])
            sums, votes = reader.read(data[start : int(offsets[-1])], offsets - start)
            size = np.diff(offsets)
            best, row = sums.argmax(1), np.arange(n)
            pred = np.where(size > 0, np.array(reader.model.langs, object)[best], UNKNOWN)
            score = np.clip(sums[row, best] / np.maximum(size, 1), 0, 1)
            yield batch, pred, score, votes[row, best] / np.maximum(size, 1)

    return label


def _lettered(text_col: str) -> Column:
    """The text, empty if it is null or has no letter."""
    text = F.col(f"`{text_col}`").cast("string")
    return F.when(text.rlike(r"\p{L}"), text).otherwise("")


def predict(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score, agreement (share of positions that carry the document's label)."""
    arrow_rows(df.sparkSession)
    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("agreement", T.DoubleType()),
        ]
    )
    names, label = schema.names, _label(model, 1)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pred, score, agree in label(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score), pa.array(agree)], names)

    return df.select(F.col(f"`{id_col}`").alias("_id"), _lettered(text_col).alias("_text")).mapInArrow(rows, schema)


def keep_known(df: DataFrame, model: Model | None, max_gap: float = MAX_GAP, text_col: str = "text") -> DataFrame:
    """The input rows, all columns, that are in a language of the model: labelled, and within ``max_gap`` of one."""
    arrow_rows(df.sparkSession)
    width, label = len(df.columns), _label(model, len(df.columns))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pred, _, _ in label(batches):
            keep = pred != UNKNOWN
            if keep.any():
                offsets, data = buffers(batch.column(width))
                start = int(offsets[0])
                keep &= gaps(model, data[start : int(offsets[-1])], offsets - start) <= max_gap
            yield batch.filter(pa.array(keep)).select(range(width))

    name = "_lettered"
    while name in df.columns:
        name += "_"
    return df.select("*", _lettered(text_col).alias(name)).mapInArrow(rows, df.schema)
