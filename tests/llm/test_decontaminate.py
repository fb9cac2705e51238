"""Edit matching against the textbook distance."""

from __future__ import annotations

import random

import numpy as np
import pytest
from fixtures import awkward, documents, words

from tideline.llm.decontaminate import ERRORS, PASSAGE, STEP, contaminated, passages, pieces, plain, within


def distance(pattern, text):
    """Least edits between the pattern and any part of the text."""
    chars = np.array([ord(d) for d in text], np.int64)
    along = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, c in enumerate(pattern, 1):
        now = row + 1
        now[0] = i
        now[1:] = np.minimum(now[1:], row[:-1] + (chars != ord(c)))
        row = np.minimum.accumulate(now - along) + along
    return int(row.min())


def test_within():
    rng = random.Random(1)
    for _ in range(300):
        p = "".join(rng.choices("abc", k=rng.randint(1, 150)))
        t = "".join(rng.choices("abc", k=rng.randint(0, 60))) + p[rng.randrange(len(p)) :] + "".join(rng.choices("abc", k=9))
        want, most = distance(p, t), rng.randint(0, 12)
        got = within(p, t, most)
        assert (got[0] if got else None) == (want if want <= most and t and want < len(p) + 1 and most >= want else None)


def test_pieces_cover_the_item():
    for n in (1, 19, 20, 127, 128, 129, 191, 192, 193, 300, 1000):
        text = "".join(chr(1000 + i) for i in range(n))
        assert set("".join(passages(text))) == set(text) and all(len(p) == min(n, PASSAGE) and p in text for p in passages(text))
        for at in range(n - (PASSAGE + STEP - 1) + 1):
            assert any(p in text[at : at + PASSAGE + STEP - 1] for p in passages(text))
        for p in passages(text):
            assert "".join(x for _, x in pieces(p)) == p and len(pieces(p)) == len(p) // ERRORS + 1


def edited(rng, text, k):
    out = list(text)
    for _ in range(k):
        at = rng.randrange(len(out))
        kind = rng.choice("sid")
        out[at : at + 1] = {"s": ["#"], "i": ["#", out[at]], "d": []}[kind]
    return "".join(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches(spark, seed):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, rng.randint(2, 60)))) for i in range(25)] + [(7, "second text of one id, long enough to match"), (None, "an item without an id but with words"), (50, None), (51, ""), (52, " \n"), (53, "ab")]
    rows = awkward(seed)
    for i in range(100, 160):
        item = rng.choice(items[:25])[1]
        part = rng.choice([item, rng.choice(passages(plain(item)))])
        rows.append((i, " ".join(words(rng, 30)) + " " + edited(rng, part, rng.choice([0, 0, 1, 2, 4, 8])).upper().replace(" ", " \n") + " " + " ".join(words(rng, 30))))
    got = {(r["id"], r["item_id"]): r["edits"] for r in contaminated(documents(spark, rows), documents(spark, items, ("item_id", "text"))).collect()}
    want = {}
    for i, t in rows:
        text = plain(t or "")
        for item, own in items:
            for p in passages(plain(own or "")):
                d = distance(p, text) if len(text) < 3000 else (0 if p in text else 99)
                if d > len(p) // ERRORS or (len(p) < 20 and f" {p} " not in f" {text} "):
                    continue
                want[(i, item)] = min(d, want.get((i, item), 99))
    assert got == want


def test_quotations_from_the_middle(spark):
    rng = random.Random(4)
    item = " ".join(words(rng, 80))[:394]
    rows = [(at, "so it says " + item[at : at + PASSAGE + STEP - 1] + " and ends") for at in range(len(plain(item)) - (PASSAGE + STEP - 1) + 1)]
    assert {r["id"] for r in contaminated(documents(spark, rows), documents(spark, [(1, item)], ("item_id", "text"))).collect()} == {i for i, _ in rows}


def test_items_without_an_id_are_one(spark):
    items = [(None, "the first text of no id, long enough"), (None, "another text of no id, as long as that"), (-1, "a text whose id is minus one, no less")]
    rows = [(1, items[0][1]), (2, items[1][1]), (3, items[2][1]), (None, items[0][1] + " " + items[2][1])]
    got = [(r["id"], r["item_id"]) for r in contaminated(documents(spark, rows), documents(spark, items, ("item_id", "text"))).collect()]
    assert sorted(got, key=str) == sorted([(1, None), (2, None), (3, -1), (None, None), (None, -1)], key=str)


def test_empty(spark):
    none, one = documents(spark, []), documents(spark, [(1, "some words of a text")])
    items = documents(spark, [], ("item_id", "text"))
    assert contaminated(one, items).collect() == [] and contaminated(none, documents(spark, [(1, "x y z")], ("item_id", "text"))).collect() == []
