"""Token counts and ids against the library on whole texts; packing."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from fixtures import awkward, documents

from tideline.llm.packing import best_fit, lower_bound, pack, plan_sequences
from tideline.llm.token_counts import token_counts, whole_tokens
from tideline.llm.tokens import Counts, Ids, latin

WORD, BYTE = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))


def odd_texts() -> list[str]:
    rng = random.Random(3)
    alphabet = " \n\t\xa0\x85\x1c  '.,aZéÀ1²½ªsdtxΣİ漢"
    beyond = "’“”–…дДЖñn\u0303J\u030cİΣσςǅᾳΆ\u0301\u200b\u2028\u3000漢字カか한글٣२ⅷ①🙂👩\u200d🚀\ufeff'sx1 .,\n"
    special = ["It’s “one” – two…", "Это не тест, а 3 слова", "漢字かな" * 400, "🙂" * 900, "J\u030c ǰ Ǆ", "a\u2028b\u3000c", "a’s<|endoftext|>д", "", " ", "<|endoftext|>", "a <|startoftext|>b<|endoftext|> c", "<|endoftext", "don't I'LL we've", "z" * 3000, "Σας ΟΔΟΣ", "é"]
    return special + ["".join(rng.choices(alphabet, k=rng.randint(1, 30))) for _ in range(2000)] + ["".join(rng.choices(beyond, k=rng.randint(1, 40))) for _ in range(2000)]


def test_ids_and_counts_equal_the_library():
    texts = odd_texts() + [t or "" for _, t in awkward()]
    counts, ids = Counts(WORD, frozenset(whole_tokens(WORD))), Ids(BYTE)
    assert ids.fast is not None
    for path, own in ((WORD, counts.count), (BYTE, lambda t: np.frombuffer(ids.ids(t), "<u4").tolist())):
        library = tokenizers.Tokenizer.from_file(path)
        for t in texts:
            want = library.encode(t, add_special_tokens=False).ids
            assert own(t) == (len(want) if path == WORD else want), t[:80]


def test_whole_tokens_are_proven():
    library, whole = tokenizers.Tokenizer.from_file(WORD), whole_tokens(WORD)
    assert len(whole) > 10_000
    assert all(len(library.encode(w, add_special_tokens=False).ids) == 1 for w in whole[::50])
    assert {"the", "é", "–"} <= set(whole) and any(not latin(w) and w.isalpha() for w in whole)


def test_few_words_beyond_latin_are_merged():
    counts = Counts(WORD, frozenset(whole_tokens(WORD)))
    asked = []
    encode = counts.encode
    counts.encode = lambda strings: asked.extend(strings) or encode(strings)
    counts.count("The word is “here” – it’s said… qzxvqzxv’s and дом")
    assert "qzxvqzxv" in asked and not {"the", "word", "is", "–", "…"} & set(asked) and max(map(len, asked)) < 12


def test_token_counts(spark):
    rows = awkward()
    library = tokenizers.Tokenizer.from_file(WORD)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 100) for i, t in rows]
    got = token_counts(documents(spark, rows), WORD, 100)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert token_counts(documents(spark, []), WORD).collect() == []


def check_plan(counts, size):
    plan = plan_sequences(counts, size)
    used = Counter()
    for times, what in plan:
        assert sum(what) <= size and times > 0
        for x in what:
            used[x] += times
    assert used == +Counter(counts)
    return sum(n for n, _ in plan)


def fewest(items, size):
    """Brute force: place the largest item in every bin it fits."""
    best = len(items)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(items):
            best = len(rooms)
            return
        for r in range(len(rooms)):
            if rooms[r] >= items[k] and rooms[r] not in rooms[:r]:
                go(k + 1, [*rooms[:r], rooms[r] - items[k], *rooms[r + 1 :]])
        go(k + 1, [*rooms, size - items[k]])

    go(0, [])
    return best


@pytest.mark.parametrize("seed", range(25))
def test_plans_are_optimal_on_small_cases(seed):
    rng = random.Random(seed)
    items = sorted((rng.randint(1, 20) for _ in range(10)), reverse=True)
    counts = Counter(items)
    got = check_plan(counts, 20)
    assert lower_bound(counts, 20) <= got == fewest(items, 20) <= sum(n for n, _ in best_fit(counts, 20))


def test_plan_for_many_equal_lengths():
    counts = {400: 100_000, 500: 100_000, 130: 300_000, 94: 50_000, 1024: 7}
    assert check_plan(counts, 1024) - lower_bound(counts, 1024) < 0.06 * lower_bound(counts, 1024)
    assert plan_sequences({}, 1024) == []


def test_packing(spark):
    rows = awkward()
    library = tokenizers.Tokenizer.from_file(BYTE)
    pieces = [r.asDict() for r in pack(documents(spark, rows), BYTE, 64).collect()]
    want = Counter()
    for i, t in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 64 or 64, len(ids), 64), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((p["id"], p["piece"], p["start"], p["length"], p["ids_crc32"]) for p in pieces) == want
    by = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 64
    assert len(by) == sum(n for n, _ in plan_sequences(Counter(p["length"] for p in pieces), 64))
    assert pack(documents(spark, []), BYTE).collect() == []
