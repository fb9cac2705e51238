"""The filter audit against going through every order, document by document."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from fixtures import awkward, documents
from fixtures import words as some_words

from tideline.llm import filter_audit as op
from tideline.llm.common import tuned

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def expected(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    label = defaultdict(lambda: (False, False))
    for i, q, x in labels:
        label[i] = (label[i][0] or q == 1, label[i][1] or x == 1)
    label[None] = (False, False)
    parts = defaultdict(list)
    for i, t, lang in rows:
        t = t or ""
        w = words(t)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t],
        }
        parts[lang or ""].append(({c for c in fails if fails[c]}, *label[i]))
    out = []
    for part, docs in parts.items():
        share, own = Counter(), []
        for order in itertools.permutations("ABCDE"):
            left = docs
            for step, c in enumerate(order, 1):
                gone = [d for d in left if c in d[0]]
                left = [d for d in left if c not in d[0]]
                share[c] += len(gone)
                redundant = sum(c in d[0] for d in docs) - len(gone)
                only = sum(d[0] == {c} for d in docs)
                own.append((part, "".join(order), step, len(left), len(gone), redundant, only, sum(d[1] for d in gone), sum(d[2] for d in gone)))
        out += [(*r, share[r[1][r[2] - 1]]) for r in own]
    return sorted(out)


def tables(spark, rows, labels):
    docs = documents(spark, [(i, t, lang) for i, t, lang in rows], ("doc_id", "text", "lang"), ("long", "string", "string"))
    return docs, documents(spark, labels, ("doc_id", "quality", "toxic"), ("long", "long", "long"))


def sample():
    rng = random.Random(5)
    noisy = [" ".join(some_words(rng, 120)).upper(), "$ " * 200, " ".join(some_words(rng, 130)) + " #", "A" * 300 + " |"]
    texts = [*awkward(), *((900 + k, t) for k, t in enumerate(noisy)), (2**60 + 1, noisy[0])]
    rows = [(i, t, rng.choice(["en", "", None, "fr"])) for i, t in texts]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i, _ in texts if rng.random() < 0.7]
    return rows, [*labels, labels[0], (None, 1, 1), (10**9, 1, 1)]


@pytest.mark.parametrize("cells", [op.SHARD_CELLS, 50])
def test_orders(spark, cells, monkeypatch):
    monkeypatch.setattr(op, "SHARD_CELLS", cells)
    rows, labels = sample()
    got = op.filter_audit(*tables(spark, rows, labels))
    assert got.columns == list(COLUMNS)
    assert sorted(map(tuple, got.collect())) == expected(rows, labels)


def test_matrix_is_one_matrix(spark, monkeypatch):
    """Shards of few cells: a word has one number in all of them, and rows hold its counts."""
    monkeypatch.setattr(op, "SHARD_CELLS", 40)
    texts = [t for _, t in awkward() if t is not None][:40]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    found, numbers = {}, {}
    shards = op.document_term_matrix(docs).collect()
    assert len(shards) > 5
    for r in shards:
        starts, place, count = (np.frombuffer(r[c], kind) for c, kind in (("starts", np.int64), ("words", np.int64), ("counts", np.uint32)))
        for k, i in enumerate(r["id"]):
            found[i] = dict(zip(place[starts[k] : starts[k + 1]].tolist(), count[starts[k] : starts[k + 1]].tolist()))
    for i, t in enumerate(texts):
        want = Counter(words(t))
        assert sorted(found[i].values()) == sorted(want.values())
        for w in want:
            numbers.setdefault(w, set(found[i])).intersection_update(found[i])
    assert all(numbers.values())
    assert len(set().union(*found.values())) == len(numbers)


def test_shards_are_small_rows_and_batches_are_small(spark):
    """What a task holds at a time does not follow from how many words or shards its partition has."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 10**9, 20_000)) for _ in range(20)]
    matrix = op.document_term_matrix(spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1))
    sizes = [sum(len(r[c]) for c in ("starts", "words", "counts")) for r in matrix.collect()]
    assert len(sizes) > 1 and max(sizes) < 3 << 20
    keys = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        rows = tuned(spark).range(40, numPartitions=1).selectExpr("repeat('x', 1000000) AS t")
        batches = rows.mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in it), "n long").collect()
    finally:
        for k in keys:
            spark.conf.set(k, before[k])
    assert len(batches) > 1 and max(r["n"] for r in batches) < 16 << 20


def test_other_filters(spark):
    rows = [(1, "a b", "x"), (2, "a b", "x"), (3, "c", "x")]
    docs, labels = tables(spark, rows, [(2, 1, 0)])
    got = {(r["filter_order"], r["step"]): r for r in op.filter_audit(docs, labels, {"S": "char_length(text) < 2"}, {"R": "repeated"}).collect()}
    assert len(got) == 4
    assert (got["RS", 1]["removed"], got["RS", 1]["good_lost"], got["SR", 1]["removed"], got["SR", 2]["kept"], got["RS", 1]["shapley"]) == (1, 1, 1, 1, 2)


def test_empty(spark):
    assert op.filter_audit(*tables(spark, [], [])).collect() == []
    got = op.filter_audit(*tables(spark, [(None, None, None)], [])).collect()
    assert len(got) == 600 and {r["part"] for r in got} == {""}
    assert {r["removed"] for r in got if r["filter_order"][r["step"] - 1] == "A"} == {1}
