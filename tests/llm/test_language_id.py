"""Language identification: filters against exact sets, n-grams against slices, held-out accuracy."""

from __future__ import annotations

import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest
from fixtures import awkward, documents
from pyspark.sql import functions as F

from tideline.llm import language_id as op
from tideline.llm.queries import op13_language_id

FOLDER = "/root/testdata/sf0.01"


def plain_ngrams(text):
    points = ["" if unicodedata.category(c)[0] not in "LM" else c for c in f"\0{text.lower()}\0"]
    return Counter(tuple(points[i : i + n]) for n in (3, 4) for i in range(len(points) - n + 1) if all(points[i + 1 : i + n - 1]))


def hashed(texts):
    out = [Counter() for _ in texts]
    for piece in op.pieces(texts):
        for grams, of in op.ngrams(*piece):
            for g, k in zip(grams.tolist(), of.tolist()):
                out[k][g] += 1
    return out


@pytest.mark.parametrize("piece", [op.PIECE, 7, 100])
def test_ngrams(piece, monkeypatch):
    """Hashes stand for n-grams one to one, wherever long texts are cut."""
    texts = ["", "a", "ab", "É-b!!cde", "日本語テキスト", "İstanbul \0x\0 \ud800y", *(t for _, t in awkward() if t and len(t) < 3000)]
    monkeypatch.setattr(op, "PIECE", piece)
    name = {}
    for got, t in zip(hashed(texts), texts):
        want = plain_ngrams(t)
        assert sorted(got.values()) == sorted(want.values())
        for n in set(want.values()):  # equal counts tell apart only some; ids must at least not clash
            if sum(v == n for v in want.values()) == 1:
                gram, code = next(k for k, v in want.items() if v == n), next(k for k, v in got.items() if v == n)
                assert name.setdefault(gram, code) == code


def languages(spark, rows):
    return op.learn(spark.createDataFrame(rows, "lang string, text string"))


def test_filters_hold_exactly_what_languages_contain(spark):
    rng = random.Random(2)
    names = [f"l{k:02}" for k in range(70)]  # more than one word of bits
    parts = {k: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=3)) for _ in range(8)] for k in names}
    rows = [(k, " ".join("".join(rng.choices(parts[k], k=2)) for _ in range(40))) for k in names for _ in range(3)]
    learnt = languages(spark, rows)
    assert learnt.table.shape[1] == 2 and sorted(learnt.names) == names
    counts = defaultdict(Counter)
    for k, t in rows:
        counts[k].update(hashed([t])[0])
    share = {k: {g: n / sum(c.values()) for g, n in c.items()} for k, c in counts.items()}
    top = Counter()
    for own in share.values():
        for g, x in own.items():
            top[g] = max(top[g], x)
    asked = [t for _, t in rows[::9]]
    got, total = learnt.contained(asked)
    for t, own, n in zip(asked, got, total):
        grams = hashed([t])[0]
        assert n == sum(grams.values())
        for k, name in enumerate(learnt.names):
            exact = sum(c for g, c in grams.items() if share[name].get(g, 0) >= op.TYPICAL * top[g])
            assert abs(own[k] - exact) <= 2 + 0.03 * n
    assert learnt.predict(asked)[0] == [k for k, _ in rows[::9]]


def test_false_positives_are_corrected():
    """A filter that is nearly full claims most n-grams; the estimate says few."""
    rng = np.random.default_rng(1)
    table = np.zeros((1024, 1), np.uint8)
    table[rng.random(1024) < 0.9] |= 1
    text = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 20_000))
    own, total = op.Languages(["x"], table).contained([text])
    assert own[0, 0] < 0.1 * total[0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    got = op13_language_id(spark, FOLDER).join(docs, "doc_id").where("held_out")
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 250 and right > 0.98


def test_awkward(spark):
    rows = [(i, t, "xx" if i is None or i % 2 else None) for i, t in awkward()] + [(500 + k, "über größe straße " * 20, "de") for k in range(5)]
    table = documents(spark, rows, ("doc_id", "text", "lang"), ("long", "string", "string"))
    got = op.identify(table, F.coalesce(F.col("doc_id") % 3 != 1, F.lit(True)))
    assert got.columns == ["id", "lang_pred", "score"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert len(found) == len(rows)
    texts = defaultdict(set)
    for i, t, _ in rows:
        texts[i].add(t)
    for i, lang, score in found:
        assert 0 <= score <= 1 and lang in ("xx", "de", "und")
        if len(texts[i]) == 1:
            (t,) = texts[i]
            assert (lang == "und") == (not t or not any(map(str.isalpha, t)))
            if t and "straße" in t:
                assert lang == "de"


def test_nothing_to_learn(spark):
    rows = [(1, "some text", None), (2, None, "en"), (3, "123", "en")]
    table = documents(spark, rows, ("doc_id", "text", "lang"), ("long", "string", "string"))
    assert {tuple(r) for r in op.identify(table, F.lit(True)).collect()} == {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0)}
    assert op.identify(table.limit(0), F.lit(True)).collect() == []
