"""Exact de-duplication against grouping in Python."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from fixtures import awkward, documents

from tideline.llm.exact_dedup import exact_dedup

SPACE = {ord(c): None for c in " \t\n\x0b\x0c\r"}


def expected(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(SPACE)].append((i, t or ""))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        out += [(i, members[0][0], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()) for k, (i, _) in enumerate(members)]
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [2, 64])
def test_groups(spark, width):
    rows = awkward()
    got = exact_dedup(documents(spark, rows), width=width)
    assert got.columns == ["id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)


def test_one_row_of_a_group_stays(spark):
    rows = [(5, "a b"), (5, "ab"), (6, "ab"), (7, "x"), (7, "x"), (None, "y"), (None, "y"), (None, " y"), (8, None), (8, "")]
    got = [tuple(r) for r in exact_dedup(documents(spark, rows)).collect()]
    assert sorted(got, key=str) == expected(rows)
    assert sum(r[3] for r in got) == len({r[4] for r in got}) == 4


def test_long_common_prefixes(spark):
    rows = [(i, "p" * 300 + str(i % 7) + "q" * 300) for i in range(50)]
    assert sorted(map(tuple, exact_dedup(documents(spark, rows), width=3).collect()), key=str) == expected(rows)


def test_empty(spark):
    assert exact_dedup(documents(spark, [])).collect() == []
