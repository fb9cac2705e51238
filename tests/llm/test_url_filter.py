"""URL verdicts against plain matching; cascades against sets."""

from __future__ import annotations

import re

import numpy as np
import pytest
from fixtures import documents
from pyspark.sql import functions as F

from tideline.llm import url_filter
from tideline.llm.queries import URL_RULES
from tideline.llm.url_filter import build, has, key_hash, url_verdicts

URLS = [
    None, "", "no scheme/path", "http://", "http://EXAMPLE.com", "http://example.com/", "http://example.com/en/x?y#z", "https://www.Example.COM/en/", "https://a.www.example.com/en/1",
    "ftp://notexample.com/en/", "http://x.net/es/", "http://net/fr/a", "http://net/de/", "http://x.net?/es/", "http://x.net#/es/", "http://x.org/en/://y.net/es/", "http://É.net/es/ü", "http://.com/", "http://a..com/x", "http://x.net/es",
]


def expected(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    raw = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(raw):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), raw)
    fits = [(len(r), r, a) for a, r in rules if (host == (h := r[: r.index("/")]) or host.endswith("." + h)) and path.startswith(r[r.index("/"):])]
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, "allow")


@pytest.mark.parametrize("rules", [URL_RULES, URL_RULES[1:2], [], [("block", "com/"), ("block", "example.com/en/x"), ("allow", "net/")]])
def test_verdicts(spark, rules):
    rows = [(i % 15, u) for i, u in enumerate(URLS * 2)] + [(None, URLS[6])]
    pages = documents(spark, rows, ("page_id", "url"))
    got = sorted(((r["id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in url_verdicts(pages, rules).collect()), key=str)
    assert got == sorted(((i, *expected(u, rules)) for i, u in rows), key=str)


def test_empty(spark):
    assert url_verdicts(documents(spark, [], ("page_id", "url")), URL_RULES).collect() == []


def test_key_hash_is_sparks(spark):
    keys = ["", "com/", "é/ü", "x" * 100]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select(F.xxhash64("k")).collect()
    assert [r[0] & 2**64 - 1 for r in got] == [key_hash(k) for k in keys]


def test_cascade_is_exact_over_the_universe(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SLACK", 40)  # as many errors as need several levels
    listed = [f"listed{i}.com/" for i in range(300)]
    others = [f"other{i}.com/" for i in range(20_000)]
    universe = spark.createDataFrame([(k,) for k in listed + others], "k string").select(F.xxhash64("k").alias("hash"))
    levels = build(listed, universe, [])
    assert len(levels) > 1
    assert has(levels, np.array([key_hash(k) for k in listed], np.uint64)).all()
    assert not has(levels, np.array([key_hash(k) for k in others], np.uint64)).any()


def test_long_hosts(spark):
    """A url has as many keys as rules have shapes, however many labels its host has."""
    urls = ["http://" + "a." * 500_000 + "example.com/en/" + "x" * 10_000, "http://" + "." * 100_000, "http://" + "b" * 1_000_000 + ".net/fr/"]
    got = url_verdicts(documents(spark, list(enumerate(urls)), ("page_id", "url")), URL_RULES).orderBy("id").collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [("example.com/en/", "block"), (None, "allow"), ("net/fr/", "block")]
