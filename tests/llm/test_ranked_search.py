"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from fixtures import awkward, documents
from fixtures import words as some_words

from tideline.llm import ranked_search as op

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(rows, items, most=20):
    docs = [(i, Counter(terms(t)), len(terms(t))) for i, t in rows if terms(t)]
    count, total = len(docs), sum(n for *_, n in docs)
    df = Counter(w for _, own, _ in docs for w in own)
    wanted = {}
    for key, text in items:
        wanted.setdefault(key, []).extend(terms(text))
    out = []
    for key, query in wanted.items():
        found = []
        for i, own, n in docs:
            m = 75 + 25 * n * count // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[w] + 1))) * (10**9 * own[w] // (1000 * own[w] + 12 * m)) for w in query)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(key, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found)[:most])]
    return sorted(out, key=str)


def benchmark(spark, items):
    return documents(spark, items, ("item_id", "text"))


def queries(rows):
    rng = random.Random(3)
    texts = [t for _, t in rows if t]
    common = " ".join(some_words(rng, 12))
    own = [(k, " ".join(rng.sample(rng.choice(texts).split() or ["x"], 1) * 2 + some_words(rng, rng.randint(0, 30))) + " " + common * (k % 3)) for k in range(40)]
    return [*own, (7, "A b é, 日本語-a a"), (None, texts[3]), (None, "a"), (100, None), (101, ""), (102, " ,;. "), (103, "unheard-of"), (104, texts[0] * 3)]


@pytest.mark.parametrize(("entries", "cells", "most"), [(op.BLOCK_ENTRIES, op.BATCH_CELLS, 20), (100, 50, 3)])
def test_scores(spark, entries, cells, most, monkeypatch):
    monkeypatch.setattr(op, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(op, "BATCH_CELLS", cells)
    rows = [*awkward(), (2**60 + 1, "Ab c"), (5, "ab C"), (4, "AB-c!")]
    items = [*queries(rows), (105, "ab")]
    got = op.ranked_search(documents(spark, rows), benchmark(spark, items), most)
    assert got.columns == ["item_id", "rank", "id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, items, most)


def test_ties_go_to_the_smallest_ids(spark):
    rows = [(i, "same text here") for i in range(200, 0, -1)] + [(None, "same text here")] * 3 + [(300 + i, "other") for i in range(300)]
    got = op.ranked_search(documents(spark, rows).repartition(7), benchmark(spark, [(1, "text")])).orderBy("rank").collect()
    assert [r["id"] for r in got] == list(range(1, 21))


def test_shared_sets_add_up():
    rng = random.Random(9)
    core = [set(rng.sample(range(60), 12)) for _ in range(5)]
    items = [rng.choice(core) | rng.choice(core) | set(rng.sample(range(60, 400), rng.randint(0, 30))) for _ in range(80)] + [set()]
    sharing = op.share_sums(items, 400)

    def leaves(symbol):
        if symbol < sharing.leaves:
            return [symbol]
        a, b = sharing.sets[symbol - sharing.leaves]
        return leaves(a) + leaves(b)

    for want, symbols in zip(items, sharing.items):
        assert sorted(x for s in symbols for x in leaves(s)) == sorted(want)
    # what is added up, once per set and once per item, is far less than term by term
    assert 2 * len(sharing.sets) + sum(map(len, sharing.items)) < 0.7 * sum(map(len, items))


def test_empty(spark):
    rows, items = awkward()[:5], [(1, "a")]
    assert op.ranked_search(documents(spark, []), benchmark(spark, items)).collect() == []
    assert op.ranked_search(documents(spark, rows), benchmark(spark, [])).collect() == []
    assert op.ranked_search(documents(spark, [(1, None), (None, " . ")]), benchmark(spark, items)).collect() == []
