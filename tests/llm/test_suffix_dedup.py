"""Repeated strings against a scan of all strings."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from fixtures import awkward, documents, words

from tideline.llm import suffix_dedup as module
from tideline.llm.suffix_dedup import LENGTH, anchors, multikey_order, suffix_dedup


def expected(rows):
    seen, out = set(), []
    texts = {}
    for i, t in rows:
        texts.setdefault((i, t or ""), 0)
        texts[(i, t or "")] += 1
    for (i, t), times in sorted((x for x in texts.items() if x[0][0] is not None), key=lambda x: x[0]):
        raw = t.encode()
        gone = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - LENGTH + 1):
            w = raw[s : s + LENGTH]
            if w in seen:
                gone[s : s + LENGTH] = True
            seen.add(w)
        out += [row(i, raw, gone)] * times
    return sorted(out + [row(None, t.encode(), np.zeros(len(t.encode()) + 1, bool)) * 1 for (i, t), n in texts.items() if i is None for _ in range(n)], key=str)


def row(i, raw, gone):
    mask = gone[:-1]
    spans = int((mask & ~np.concatenate([[False], mask[:-1]])).sum()) if len(mask) else 0
    return (i, len(raw), int(mask.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~mask].tobytes()).hexdigest())


def result(df):
    return sorted((tuple(r) for r in df.drop("kept").collect()), key=str)


def passages(seed, n=60):
    """Texts that share passages of all lengths around the limit, at odd places, with different neighbours."""
    rng = random.Random(seed)
    shared = ["".join(rng.choices("abcdef é", k=rng.randint(70, 260))) for _ in range(8)] + ["z" * 300, "ab" * 120, "éñ" * 80]
    out = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(shared)
            a = rng.randrange(len(p) // 3)
            parts += [" ".join(words(rng, rng.randint(0, 15))), p[a : len(p) - rng.randrange(len(p) // 3)]]
        out.append((i * 2, "".join(parts)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("bucket", [100_000, 20])
@pytest.mark.parametrize("seed", [1, 2])
def test_passages(spark, seed, bucket):
    rows = passages(seed)
    assert result(suffix_dedup(documents(spark, rows), bucket=bucket)) == expected(rows)


def test_one_line_in_every_text(spark):
    rng = random.Random(5)
    line = "".join(rng.choices("abcdefgh ", k=150))
    rows = [(i, " ".join(words(rng, 20)) + line + " ".join(words(rng, 20))) for i in range(200)]
    assert result(suffix_dedup(documents(spark, rows), bucket=10)) == expected(rows)


def test_awkward(spark):
    rows = awkward()
    got = suffix_dedup(documents(spark, rows))
    assert got.columns == ["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    assert result(got) == expected(rows)
    assert suffix_dedup(documents(spark, [])).collect() == []


def test_buckets_of_one_partition_are_held_one_by_one(monkeypatch):
    import pandas as pd

    rng = np.random.default_rng(3)
    parts = []
    for bucket in range(4):
        around = rng.integers(97, 123, (60, module.AROUND), np.uint8)
        around[30:] = around[:30]
        own = {"id": np.arange(60) + 100 * bucket, "th": 0, "pos": 500, "lft": module.SIDE, "rgt": module.SIDE, "around": [x.tobytes() for x in around], "bucket": bucket}
        parts.append(pd.DataFrame(own))
    rows = pd.concat(parts, ignore_index=True)
    sizes = []
    whole = module.earlier_strings
    monkeypatch.setattr(module, "earlier_strings", lambda around, *sides: (sizes.append(len(around)), whole(around, *sides))[1])
    found = pd.concat(list(module._bucket_intervals([rows[:37], rows[37:37], rows[37:150], rows[150:]])))
    assert sizes == [60] * 4  # not all 240 at once
    assert sorted(found["id"]) == [100 * b + k for b in range(4) for k in range(30, 60)]
    assert set(found["first"]) == {500 - module.SIDE} and set(found["stop"]) == {500 + module.GRAM + module.SIDE}


def test_memory_of_a_bucket():
    import tracemalloc

    around = np.random.default_rng(4).integers(97, 100, (20_000, module.AROUND), np.uint8)
    around[10_000:] = around[:10_000]
    sides = np.full(20_000, module.SIDE)
    tracemalloc.start()
    try:
        low, high = module.earlier_strings(around, sides, sides)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (low[10_000:] == 0).all() and (high[10_000:] == module.SIDE).all() and (low[:10_000] == -1).all()
    assert peak < 4 * around.nbytes


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(module, "CHUNK", 500)
    rows = passages(7, 20) + [(1000, "".join(t for _, t in passages(7, 20))), (1001, "".join(t for _, t in passages(8, 10)))]
    for batch in (rows,):
        import pandas as pd

        found = pd.concat(list(module._anchor_rows([pd.DataFrame(batch, columns=["id", "text"])])))
        own = {(i, p) for i, p in zip(found["id"], found["pos"])}
        for i, t in batch:  # every string owns an anchor, the same wherever it stands
            raw = np.frombuffer(t.encode(), np.uint8)
            at = set(anchors(raw, np.array([len(raw)]))[0].tolist()) if len(raw) >= LENGTH and len(raw) < 1200 else None
            assert at is None or at <= {p for j, p in own if j == i}


def test_equal_strings_own_equal_anchors():
    rng = np.random.default_rng(2)
    for _ in range(50):
        common = rng.integers(97, 101, int(rng.integers(LENGTH, 3 * LENGTH)), np.uint8)
        found = []
        for _ in range(2):
            before = rng.integers(97, 123, int(rng.integers(0, 200)), np.uint8)
            data = np.concatenate([before, common, rng.integers(97, 123, int(rng.integers(0, 200)), np.uint8)])
            at, _ = anchors(data, np.array([len(data)]))
            found.append(set((at - len(before)).tolist()))
        for s in range(len(common) - LENGTH + 1):
            inside = set(range(s, s + LENGTH - module.GRAM + 1))
            assert inside & found[0] & found[1]


def test_multikey_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (500, 37), np.uint8)
    rows[:250, :30] = 1
    assert [bytes(rows[i]) for i in multikey_order(rows)] == sorted(map(bytes, rows))
