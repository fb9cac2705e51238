"""Jaccard classes against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from fixtures import awkward, documents, words

from tideline.llm import jaccard
from tideline.llm.common import components
from tideline.llm.jaccard import jaccard_classes, needed, parity, prefix, shingles


def plain_set(text, width):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def expected(rows, width, percent):
    sets = [plain_set(t, width) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        reach = [rows[j][0] for j in range(len(rows)) if find(j) == find(i)]
        out.append((doc, len(sets[i]), None if doc is None else min(reach)))
    return sorted(out, key=str)


def variants(seed, groups=12, copies=8, length=80):
    """Groups of near copies at all distances from their first text."""
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = words(rng, rng.randint(3, length))
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(["new", "other"])
            if rng.random() < 0.2:
                own = own[: -rng.randint(1, 3)] or own
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("width,percent,seed", [(3, 90, 1), (5, 80, 2), (1, 50, 3), (2, 70, 4)])
def test_classes(spark, width, percent, seed):
    rows = variants(seed)
    got = jaccard_classes(documents(spark, rows), width, percent)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, width, percent)


def test_awkward(spark):
    rows = awkward()
    got = jaccard_classes(documents(spark, rows), 3, 90)
    assert got.columns == ["id", "n_shingles", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, 3, 90)
    assert jaccard_classes(documents(spark, [])).collect() == []


def test_different_texts_under_one_id(spark):
    rng = random.Random(6)
    rows = []
    for k in range(12):  # one id holds a short and a long text, each with a near copy under another id
        for n, other in ((30, 100 + k), (90, 200 + k)):
            base = words(rng, n)
            rows += [(k, " ".join(base)), (other, " ".join([*base[:-1], "new"]))]
    rows += [rows[0], (None, rows[0][1]), (3, ""), (500, rows[2][1])]
    got = jaccard_classes(documents(spark, rows), 3, 80)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, 3, 80)


def test_frequent_shingles_and_a_large_group(spark):
    rng = random.Random(9)
    passage = " ".join(words(rng, 40))
    rows = [(i, passage + " " + " ".join(words(rng, rng.randint(1, 12)))) for i in range(150)]
    base = words(rng, 60)
    for i in range(150, 300):
        own = list(base)
        own[rng.randrange(60)] = f"w{i}"
        rows.append((i, " ".join(own)))
    got = jaccard_classes(documents(spark, rows), 3, 90)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, 3, 90)


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_prefixes_and_sketches_lose_no_pair(percent, monkeypatch):
    rng = np.random.default_rng(percent)
    sketch = rng.integers(0, 50, jaccard.COUNTERS).astype(np.int32)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        x = np.unique(rng.integers(0, 2**63, n, np.uint64))
        keep = rng.random(len(x)) < rng.choice([0.8, 0.9, 0.97, 1])
        y = np.unique(np.concatenate([x[keep], rng.integers(0, 2**63, int(rng.integers(0, 8)), np.uint64)]))
        if not len(y):
            continue
        both = len(np.intersect1d(x, y))
        differ = int(np.bitwise_count((parity(x) ^ parity(y)).view(np.uint64)).sum())
        assert differ <= len(x) + len(y) - 2 * both
        if 100 * both >= percent * (len(x) + len(y) - both):
            (px, sx), (py, sy) = (prefix(s, sketch, 20.0, percent) for s in (x, y))
            share = min(sx, sy)
            px, py = (p[: len(s) - needed(len(s), percent) + share] for p, s in ((px, x), (py, y)))
            assert len(np.intersect1d(px, py)) >= share


def test_shingles_of_few_words():
    assert len(shingles("", 3)) == 0 and len(shingles(" \n", 3)) == 0
    assert len(shingles("a b", 3)) == 1 and len(shingles("a b a b a", 2)) == 2
    assert set(shingles("A b", 3)) == set(shingles("a\tB", 3)) != set(shingles("b a", 3))


def test_word_hashes_tell_words_apart(monkeypatch):
    """As many hashes as words, alike wherever a word stands and however its text is cut."""
    rng = random.Random(7)
    blanks = " \t\n\x0b\x0c\r"
    found = [*words(rng, 400), "é", "É", "日本", "x" * 63, "x" * 64, "x" * 65, "x" * 5000, "ab", "ba", "a", "b", "\x1c", "\x85", "\xa0z"] * 2
    text = "".join(w + rng.choice(blanks) * rng.randint(1, 3) for w in found)
    whole = jaccard.word_hashes(text)
    assert len(whole) == len(found) and len(set(whole.tolist())) == len(set(found))
    assert {w: h for w, h in zip(found, whole.tolist())} == {w: jaccard.word_hashes(w.upper() if w.isascii() else w)[0] for w in found}
    monkeypatch.setattr(jaccard, "PART_BYTES", 40)
    assert (jaccard.word_hashes(text) == whole).all() and (jaccard.word_hashes(blanks + text) == whole).all()
    assert len(jaccard.word_hashes(blanks * 30)) == 0


def test_prefix_is_that_of_a_whole_sort():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 60, 900):
        s = np.unique(rng.integers(0, 2**63, n, np.uint64) & ~np.uint64(0xF << 40) | np.uint64(3 << 62))
        s[1::2] = s[::2][: len(s[1::2])] | np.uint64(1)  # pairs that only low bits tell apart
        s = np.unique(s)
        sketch = rng.integers(0, 3, jaccard.COUNTERS).astype(np.int32)
        count = sketch[s % np.uint64(jaccard.COUNTERS)].astype(np.uint64)
        order = np.argsort(count << np.uint64(32) | s >> np.uint64(32), kind="stable")
        got, _ = prefix(s, sketch, 0.0, 90)
        assert (got == s[order[: len(got)]]).all()


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, k) for k in range(500, 560)] + [(rng.randint(2000, 2200), rng.randint(2000, 2200)) for _ in range(150)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    linked = {x for a, b in edges for x in (a, b) if a != b}
    assert got == {x: find(x) for x in linked}


def test_long_sets_are_not_read_for_a_few_common_words(spark, monkeypatch):
    """Any two long sets share some rare words; the wide sketch tells them apart, and copies still link."""
    rng = np.random.default_rng(8)
    texts = [rng.choice(30_000, 3000, replace=False) for _ in range(30)]
    for k in (0, 1):
        copy = texts[k].copy()
        copy[:100] = 30_000 + np.arange(100)
        texts.append(copy)
    read = []
    whole = jaccard._verified
    monkeypatch.setattr(jaccard, "_verified", lambda pairs, *more: (read.append(sorted(map(tuple, pairs.collect()))), whole(pairs, *more))[1])
    rows = [(i, " ".join(f"w{x}" for x in t)) for i, t in enumerate(texts)]
    got = jaccard_classes(documents(spark, rows), 1, 90)
    assert {(r["id"], r["component_id"]) for r in got.collect()} == {(i, i) for i in range(30)} | {(30, 0), (31, 1)}
    assert {p for pairs in read for p in pairs} == {(0, 30), (1, 31)}


def test_sketches_never_part_similar_sets():
    rng = np.random.default_rng(9)
    for percent in (50, 80, 90, 99):
        for n in (3, 40, 700, 5000):
            a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            gone = len(a) * (100 - percent) // 100
            b = a[gone:]
            for size in (jaccard.BITS, jaccard.WIDE_BITS):
                differ = int(np.bitwise_count((parity(a, size) ^ parity(b, size)).view(np.uint64)).sum())
                assert differ <= gone and differ * (100 + percent) <= (len(a) + len(b)) * (100 - percent)
    assert jaccard.wide_from(90) == 1945 and jaccard.wide_from(100) > 0
