"""A quality classifier: random-indexing word vectors, pooled, then a small calibrated network.

A word's vector is the sum of its neighbours' sparse ternary index vectors over the
whole corpus.  Words and their shapes (letter case, digits, marks) share a hashed
vocabulary of fixed size, so the vectors are as large for any corpus.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import DISTINCT_WORDS, frame, mix, summed_blocks, texts

ENTRIES = 1 << 15  # rows of the hashed vocabulary
WIDTH = 32  # dimensions of a word vector
MARKS = 2  # places of an index vector that are not zero
REACH = 4  # neighbours on either side, words and shapes counted apart
BLOCKS = 64
LABELLED = 20_000  # most labelled rows the network is fitted on: those whose ids hash lowest
COMMON = 1e-3  # words this frequent weigh half

_RUNS = re.compile(r"(.)\1+", re.S)
_LETTERS = [(re.compile(r"[^\W\d_]+"), lambda m: "A" if m[0].isupper() and len(m[0]) > 1 else "a"), (re.compile(r"\d+"), "0")]


def shape(word: str) -> str:
    """Letters, digits and runs cut down; most words are letters with at most one mark behind them."""
    letters, mark = (word, "") if word[-1:].isalnum() else (word[:-1], word[-1:])
    if letters.isalpha():
        return ("A" if len(letters) > 1 and letters.isupper() else "a") + mark
    for pattern, by in _LETTERS:
        word = pattern.sub(by, word)
    return _RUNS.sub(r"\1\1", word)[:12]


class ShapeRows(dict):
    """``shape -> row``; shapes are short, and few."""

    def __missing__(self, of: str) -> int:
        if len(self) > DISTINCT_WORDS:
            self.clear()
        got = self[of] = xxhash.xxh3_64_intdigest(b"\0" + of.encode("utf-8", "replace")) % (ENTRIES - 1) + 1
        return got


_SHAPES = ShapeRows()


class Vocabulary(dict):
    """``word -> (row of its lower-case form, row of its shape)`` as one number."""

    def __missing__(self, word: str) -> int:
        if len(self) > DISTINCT_WORDS:
            self.clear()
        a = xxhash.xxh3_64_intdigest(word.lower().strip(".,;:!?").encode("utf-8", "replace")) % (ENTRIES - 1) + 1
        got = a | _SHAPES[shape(word)] << 16
        if len(word) <= 64:
            self[word] = got
        return got


_VOCABULARY = Vocabulary()


def rows_of(text: str) -> np.ndarray:
    """Rows of a text's words and shapes, in turn."""
    words = text.split()
    pairs = np.fromiter(map(_VOCABULARY.__getitem__, words), np.int64, len(words))
    out = np.empty(2 * len(words), np.int64)
    out[0::2], out[1::2] = pairs & 0xFFFF, pairs >> 16
    return out


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each row's index vector; row 0 is no word and has none."""
    h = np.stack([mix(np.arange(ENTRIES, dtype=np.uint64) * np.uint64(MARKS) + np.uint64(k + 1)) for k in range(MARKS)])
    sign = np.where(h >> np.uint64(40) & np.uint64(1), 1.0, -1.0)
    sign[:, 0] = 0
    return (h % np.uint64(WIDTH)).astype(np.int64), sign


def word_vectors(rows: DataFrame) -> np.ndarray:
    """Unit vectors of the vocabulary from all of ``rows (text)``, common words scaled down."""
    columns = WIDTH + 1  # the last one counts

    def gather(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, sign = index_vectors()
        total = np.zeros(ENTRIES * columns, np.int64)
        gap = np.zeros(REACH, np.int64)
        for pdf in batches:
            for k in range(0, len(pdf), 500):
                seq = np.concatenate([gap, *itertools.chain.from_iterable((rows_of(t), gap) for t in pdf["text"].iloc[k : k + 500])])
                base = seq * columns
                total += np.bincount(base + WIDTH, minlength=len(total))
                for off in range(1, REACH + 1):
                    for one, other in ((base[off:], seq[:-off]), (base[:-off], seq[off:])):
                        for m in range(MARKS):
                            total += np.bincount(one + place[m][other], sign[m][other], len(total)).astype(np.int64)
        for b, part in enumerate(np.split(total, BLOCKS)):
            yield frame({"block": [b], "data": [part.astype(np.int64).tobytes()]})

    parts = rows.select("text").mapInPandas(gather, "block int, data binary")
    sums = summed_blocks(parts, ENTRIES * columns, "int64").reshape(ENTRIES, columns).astype(np.float64)
    sums[0] = 0
    vectors, count = sums[:, :WIDTH], sums[:, WIDTH]
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    share = count / max(count.sum(), 1)
    return (vectors * (COMMON / (COMMON + share))[:, None]).astype(np.float32)


FEATURES = 4 * WIDTH + 6


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the word and shape vectors, variety, repeats, length; zeros for no words."""
    out = np.zeros(FEATURES, np.float32)
    rows = rows_of(text)
    if not len(rows):
        return out
    for k in (0, 1):
        own = rows[k::2]
        v = vectors[own]
        mean, square = v.mean(0), np.einsum("ij,ij->j", v, v) / len(own)
        out[2 * k * WIDTH : (2 * k + 1) * WIDTH] = mean
        out[(2 * k + 1) * WIDTH : (2 * k + 2) * WIDTH] = np.sqrt(np.maximum(square - mean * mean, 0))
        out[4 * WIDTH + k] = len(np.unique(own)) / len(own) ** 0.8
        out[4 * WIDTH + 2 + k] = (own[1:] == own[:-1]).sum() / len(own)
    out[4 * WIDTH + 4] = np.log(len(rows))
    out[4 * WIDTH + 5] = len(text) / len(rows)
    return out


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the logit."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(((x - self.mean) / self.scale) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7) -> Network:
    """Adam on four fifths; the epoch and the temperature that the last fifth likes best.

    With no row, or labels of one kind only, the network is constant: one half, or
    that label's smoothed share.
    """
    x, y = x.astype(np.float64), y.astype(np.float64)
    rng = np.random.default_rng(seed)
    size = x.shape[1]
    mean, scale = (x.mean(0), x.std(0) + 1e-3) if len(x) else (np.zeros(size), np.ones(size))
    net = Network(mean, scale, rng.normal(0, (2 / size) ** 0.5, (size, hidden)), np.zeros(hidden), rng.normal(0, 0.1, hidden), 0.0)
    if len(x) < 10 or y.min() == y.max():
        prior = (y.sum() + 1) / (len(y) + 2)
        net.w2[:] = 0
        net.b2 = float(np.log(prior / (1 - prior)))
        return net
    order = rng.permutation(len(x))
    held, own = order[: len(x) // 5], order[len(x) // 5 :]
    z = (x - mean) / scale
    params = [net.w1, net.b1, net.w2, np.array([np.log(y.mean() / (1 - y.mean()))])]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]

    def loss(logits: np.ndarray, want: np.ndarray) -> float:
        return float(np.mean(np.logaddexp(0, logits) - want * logits))

    best, step = (np.inf, None), 0
    for _ in range(epochs):
        rng.shuffle(own)
        for k in range(0, len(own), 256):
            at = own[k : k + 256]
            h = np.maximum(z[at] @ params[0] + params[1], 0)
            d = (1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -40, 40))) - y[at]) / len(at)
            back = np.outer(d, params[2]) * (h > 0)
            grads = [z[at].T @ back + 1e-4 * params[0], back.sum(0), h.T @ d, np.array([d.sum()])]
            step += 1
            for p, g, (m, v) in zip(params, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.003 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        now = loss(np.maximum(z[held] @ params[0] + params[1], 0) @ params[2] + params[3], y[held])
        if now < best[0]:
            best = (now, [p.copy() for p in params])
    net.w1, net.b1, net.w2, net.b2 = *best[1][:3], float(best[1][3][0])
    logits = net.logit(x[held])
    net.temperature = min(np.geomspace(0.25, 4, 65), key=lambda t: loss(logits / t, y[held]))
    return net


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """Whether the checksum of an id's text falls in a fold; never for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """``id, label`` of the quality labels outside the held-out fold."""
    return labels.where(~held_out("doc_id", 3, 1)).select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))


def lowest_labels(labels: DataFrame, n: int) -> DataFrame:
    """The ``n`` distinct ``(id, label)`` of lowest hashes; nulls are left out.

    Hashes are counted by their first 16 bits, so tasks send what lies in the prefixes
    that hold the lowest ``n``, and no more: ``n`` rows and those of one prefix.
    """
    known = labels.where("label IS NOT NULL AND id IS NOT NULL").select("id", "label").distinct()
    first = F.shiftright(F.xxhash64("id"), 48)
    counts = sorted((r["prefix"], r["n"]) for r in known.groupBy(first.alias("prefix")).agg(F.count("*").alias("n")).collect())
    upto = next((prefix for (prefix, _), total in zip(counts, itertools.accumulate(k for _, k in counts)) if total >= n), None)
    low = known if upto is None else known.where(first <= upto)
    return low.orderBy(F.xxhash64("id"), "id", "label").limit(n)


def quality_of(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> Callable[[Column], Column]:
    """A function that scores a text column, learnt from all texts and from ``labels (id, label)``."""
    rows = texts(docs, id_col, text_col)
    vectors = rows.sparkSession.sparkContext.broadcast(word_vectors(rows))
    some = lowest_labels(labels, labelled)

    def features(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield frame({"label": pdf["label"], "x": [pooled(t, vectors.value).tobytes() for t in pdf["text"]]})

    # At most ``labelled`` ids are sent to the tasks, and one text of each comes back, however many rows share an id.
    one = rows.join(F.broadcast(some), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    got = one.select("label", "text").mapInPandas(features, "label int, x binary").toPandas()
    order = got.sort_values(["label", "x"])
    x = np.frombuffer(b"".join(order["x"]), np.float32).reshape(-1, FEATURES)
    net = rows.sparkSession.sparkContext.broadcast(fit(x, order["label"].to_numpy(np.float64)))

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        x = np.array([pooled(t, vectors.value) for t in text], np.float64).reshape(-1, FEATURES)
        return pd.Series(net.value.score(x), dtype=float)

    return score


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: int = LABELLED) -> DataFrame:
    """``id, score`` of every row: how likely its text has label 1.

    ``labels (id, label)`` are the rows to learn from, at most ``labelled`` of them;
    null labels are left out, and a document with several counts once for each.  Of
    different texts under one labelled id the least is learnt from.
    Word vectors come from all texts.  A null text counts as empty; empty texts get
    the network's answer to no words.  Without labels every score is one half.
    Repeated rows are scored alike, a null id stays null, an empty table gives an
    empty result, other columns are ignored.
    """
    score = quality_of(docs, labels, id_col, text_col, labelled)
    return texts(docs, id_col, text_col).select("id", score("text").alias("score"))
