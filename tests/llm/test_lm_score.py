"""The lattice against all segmentations, base scores against counting, held-out gain."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from fixtures import awkward, documents, words
from pyspark.sql import functions as F

from tideline.llm import lm_score
from tideline.llm.lm_score import START, Lattice, learn_pieces, score_texts

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lattice():
    return Lattice(PATH)


def spellings(lattice, text):
    """Probability and piece list of every segmentation."""
    if not text:
        yield 1.0, []
    for j in range(1, len(text) + 1):
        piece = lattice.trie.get(text[:j], -1)
        if piece >= 0:
            for p, rest in spellings(lattice, text[j:]):
                yield p * lattice.weights[piece], [piece, *rest]
    if text and lattice.trie.get(text[0], -1) < 0:
        spelt = lattice.spelling(text[0])
        for p, rest in spellings(lattice, text[1:]):
            yield p * math.prod(lattice.weights[b] for b in spelt), [*spelt, *rest]


@pytest.mark.parametrize("word", ["a", "the", "hello", "qzx", "日x", "\x00", "don't"])
def test_marginal_and_expected_counts(lattice, word, monkeypatch):
    found = list(spellings(lattice, START + word))
    total = sum(p for p, _ in found)
    assert lattice.log_probability(word) == pytest.approx(math.log(total))
    want = Counter()
    for p, pieces in found:
        for x in pieces:
            want[x] += p / total
    for plain in (True, False):
        if not plain:
            monkeypatch.setattr(lattice, "_expect_plain", lambda *a: False)
        for times in (1, 3):
            got = [0.0] * lattice.size
            lattice.expect(word, got, times)
            assert {i: n / times for i, n in enumerate(got) if n > 1e-6 * times} == pytest.approx({i: n for i, n in want.items() if n > 1e-6}, rel=1e-4)


def test_weights_sum_to_one(spark, lattice):
    assert lattice.weights.sum() == pytest.approx(1)
    counts = spark.createDataFrame([("anberanber", 3), ("corber", 1), ("unseen", 0)], "word string, c long")
    learnt = learn_pieces(counts, PATH)
    assert learnt.sum() == pytest.approx(1) and len(learnt) == lattice.size


def test_long_words_do_not_underflow(lattice):
    assert -1e6 < lattice.log_probability("漢" * 3000) < -1000
    lattice.expect("漢" * 500, [0.0] * lattice.size)


def test_words_in_bulk_are_those_one_by_one(lattice, monkeypatch):
    rng = random.Random(3)
    found = [*words(rng, 300), "a", "日x", "漢" * 20, "漢" * 500, "x" * 62, "x" * 63, "x" * 64, "y" * 3000, START, "a" + START + "b", "\x00", "é😀ß", "don't", "don't"]
    times = [rng.randint(1, 5) for _ in found]
    one, counts = [lattice.log_probability(w) for w in found], [0.0] * lattice.size
    for w, n in zip(found, times):
        lattice.expect(w, counts, n)
    assert lattice.log_probabilities(found).tolist() == pytest.approx(one, rel=1e-12)
    assert lattice.expect_all(found, np.array(times, float)).tolist() == pytest.approx(counts, rel=1e-9, abs=1e-12)
    assert lattice.log_probabilities([]).tolist() == [] and not lattice.expect_all([], np.zeros(0)).any()
    # only what plain numbers do not hold goes one by one
    alone = []
    monkeypatch.setattr(lattice, "log_probability", lambda w: alone.append(w) or 0.0)
    lattice.log_probabilities(found)
    assert alone == ["漢" * 20, "漢" * 500, "x" * 64, "y" * 3000]


def brute(rows):
    train = [(t or "").encode().lower().split() for i, t in rows if i is None or i % 3 != 0]
    c = Counter(w for d in train for w in d)
    total, kinds = sum(c.values()) + len(train), len(c) + bool(train)

    def base(k):
        return math.log10((k + 0.1) / (total + 0.1 * (kinds + 1)))

    out = []
    for i, t in rows:
        found = (t or "").encode().lower().split()
        out.append((i, len(found) + 1, sum(w in c for w in found) + bool(train), total, round(sum(base(c[w]) for w in found) + base(len(train)), 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [1_000_000, 50])
def test_awkward(spark, hot, monkeypatch):
    monkeypatch.setattr(lm_score, "HOT_SHARE", hot)
    rows = awkward()
    got = score_texts(documents(spark, rows), F.col("doc_id").isNull() | (F.col("doc_id") % 3 != 0), PATH).collect()
    assert sorted(((r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got), key=str) == brute(rows)
    assert all(r[s] < 0 and math.isfinite(r[s]) for r in got for s in ("score", "mixed_score"))
    by = {}
    for r in got:  # equal texts score alike
        assert by.setdefault((r["id"], r["n_tokens"]), round(r["score"], 6)) == round(r["score"], 6)


@pytest.mark.parametrize("hot", [1_000_000, 5])
def test_scores_against_all_segmentations(spark, hot, monkeypatch):
    monkeypatch.setattr(lm_score, "HOT_SHARE", hot)
    rows = [(1, "the cat saw the hat"), (2, "the hat"), (3, "a zqx the"), (4, None), (5, "The CAT\n日x the the"), (6, "the cat saw the hat")]
    held = {3, 5}
    train = [(t or "").lower().split() for i, t in rows if i not in held]
    start = Lattice(PATH)
    expected = lm_score.PRIOR * start.weights
    for w, c in Counter(w for d in train for w in d).items():
        found = list(spellings(start, START + w))
        total = sum(p for p, _ in found)
        for p, pieces in found:
            for x in pieces:
                expected[x] += c * p / total
    learnt = Lattice(PATH, expected / expected.sum())
    n_words, n_ends = sum(map(len, train)), len(train)
    end = (n_ends + 0.5) / (n_words + n_ends + 1)
    want = {}
    for i, t in rows:
        found = (t or "").lower().split()
        want[i] = math.log10(end) + sum(math.log10(sum(p for p, _ in spellings(learnt, START + w)) * (1 - end)) for w in found)
    got = {r["id"]: r["score"] for r in score_texts(documents(spark, rows), ~F.col("doc_id").isin(*held), PATH).collect()}
    assert got == pytest.approx(want, rel=1e-9)


def test_hot_and_joined_words_score_alike(spark, monkeypatch):
    rows, scores = awkward(2), []
    for hot in (1_000_000, 50):
        monkeypatch.setattr(lm_score, "HOT_SHARE", hot)
        got = score_texts(documents(spark, rows), F.lit(True), PATH).collect()
        scores.append(sorted((str(r["id"]), r["n_tokens"], round(r["score"], 5), round(r["mixed_score"], 5)) for r in got))
    assert scores[0] == scores[1]


def test_no_training_rows_and_no_rows(spark):
    got = score_texts(documents(spark, [(1, "a b"), (2, None)]), F.lit(False), PATH).collect()
    assert {r["id"]: (r["n_tokens"], r["n_known"], r["train_tokens"]) for r in got} == {1: (3, 0, 0), 2: (1, 0, 0)}
    assert score_texts(documents(spark, []), F.lit(True), PATH).collect() == []


def test_texts_of_the_language_are_likelier(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(words(rng, 50))) for i in range(1, 200)]
    # held out, like the rows they are made from
    shuffled = [(3000 + i, " ".join("".join(rng.sample(w, len(w))) for w in t.split())) for i, t in rows if i % 3 == 0]
    scored = score_texts(documents(spark, rows + shuffled), F.col("doc_id") % 3 != 0, PATH).collect()
    for column in ("score", "mixed_score"):
        got = {r["id"]: r[column] for r in scored}
        assert all(got[i] > got[3000 + i] + 5 for i, _ in rows if i % 3 == 0)
