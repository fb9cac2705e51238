"""Trees of broken pages, decoding against brute force, extraction of known pages."""

from __future__ import annotations

import html
import itertools
import random
import re
import time

import numpy as np
import pytest
from fixtures import documents

from tideline.llm.boosting import fit_trees
from tideline.llm.html_text import GONE, KEPT, decode, features, learn, main_text, training_page
from tideline.llm.html_tree import Page

PAGES = "/root/testdata/sf0.001/pages.parquet"


def blocks(source):
    return [t for t in Page(source).text if t]


@pytest.mark.parametrize(
    "source,want",
    [
        ("", []),
        ("plain &amp; text", ["plain & text"]),
        ("<p>a<p>b", ["a", "b"]),
        ("<p><b>a<br><p>b</b> c</p>", ["a", "b c"]),
        ("<ul><li>a<li>b <i>c</i></ul>d", ["a", "b c", "d"]),
        ("x<script>var t='</p><p>no';</script>y<style>p{}</style>z", ["xyz"]),
        ("<!-- <p>no</p> -->a<!doctype html>b", ["ab"]),
        ("<div>a<div>b</div>c</div></div></p>d", ["a", "b", "c", "d"]),
        ("<p title='a>b' data-x=\"</p>\">c</p>", ["c"]),
        ("a < b and c<3", ["a < b and c<3"]),
        ("<p>a\n\t  b&nbsp; c</p>", ["a b c"]),
        ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
        ("<script>never closed <p>x", []),
        ("<p>un<b>closed", ["unclosed"]),
        ("<head><title>t</title></head><body>x</body>", ["x"]),
        ("<article><h1>A&#233;&lt;b&gt;</h1>t</article>", ["Aé<b>", "t"]),
        ("<head><title>t</title><body><article>x</article>", ["x"]),
        ("<html><head><meta charset=utf-8><style>p{}</style><p>x</p><p>y", ["x", "y"]),
        ("<p>a<svg class='i' viewBox=\"0 0 1 1\"/>b</p><p>c<math/></p><svg><path d='M0'/></svg><p>d</p>", ["ab", "c", "d"]),
        ("<p>a<svg width=1/>no</svg>b</p>", ["ab"]),
        ("<p title=don't>a</p><p>b</p><p title=won't>c</p>", ["a", "b", "c"]),
        ("<p it's = 'a>b' x=y='z>c</p>", ["c"]),
        ("<script data-x=don't>no</script><p>a</p><p>it's</p>", ["a", "it's"]),
    ],
)
def test_blocks(source, want):
    assert blocks(source) == want


def test_deep_and_long_pages():
    assert blocks("<div>" * 3000 + "x") == ["x"]
    page = Page("<p>" + "word " * 200_000 + "</p>" + "<p>y</p>" * 500)
    assert features(page).shape[0] == len(page.tag)


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(1)
    for _ in range(30):
        page = Page("<div>a<p>b</p><div><p>c</p>d</div></div><p>e</p>")
        z = rng.normal(0, 2, len(page.tag))
        yes, no = -np.logaddexp(0, -z), -np.logaddexp(0, z)
        best, kept = -np.inf, None
        for labels in itertools.product([0, 1], repeat=len(z)):
            if all(labels[i] <= labels[page.parent[i]] for i in range(1, len(z))):
                score = sum(yes[i] if x else no[i] for i, x in enumerate(labels))
                if score > best:
                    best, kept = score, [t for t, x in zip(page.text, labels) if x and t]
        assert decode(page, z) == kept


def test_boosting_learns_a_rule():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 5)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit_trees(x[:3000], y[:3000])
    assert ((model.logit(x[3000:]) > 0) == y[3000:]).mean() > 0.95
    assert fit_trees(x[:0], y[:0]).logit(x[:3]).shape == (3,)


def truth(source):
    body = re.search(r"<article>(.*?)</article>", source, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"<br>", " ", b))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(p for p in parts if p)


def test_pages_of_the_corpus(spark):
    pages = spark.read.parquet(PAGES)
    rows = {r["page_id"]: r["html"] for r in pages.collect()}
    got = main_text(pages).collect()
    assert {r["id"]: r["text"] for r in got} == {i: truth(s) for i, s in rows.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_other_markups(spark):
    sources = [r["html"] for r in spark.read.parquet(PAGES.replace("0.001", "0.01")).orderBy("page_id").collect()]
    trees, rng = learn(sources[:60]), random.Random(5)
    good = missed = extra = 0
    for k in range(150):
        page = Page(training_page([sources[60 + k % (len(sources) - 60)], *rng.choices(sources, k=2)], rng))
        want = [t.replace(KEPT, "").replace(GONE, "") for t in page.text if KEPT in t]
        page.text = [t.replace(KEPT, "").replace(GONE, "") for t in page.text]
        got = decode(page, trees.logit(features(page)))
        good, missed, extra = good + len(want), missed + len([t for t in want if t not in got]), extra + len([t for t in got if t not in want])
    assert missed + extra < 0.08 * good


def test_optional_tags_of_the_corpus(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(PAGES).collect()]
    cut = [(i, u, h.replace("</head>", "").replace("<article>", "<svg class=icon /><article title=don't>", 1)) for i, u, h in rows]
    assert all("</head>" in h for _, _, h in rows)
    got = main_text(documents(spark, cut, ("page_id", "url", "html"), ("long", "string", "string"))).collect()
    assert {r["id"]: r["text"] for r in got} == {i: truth(h) for i, _, h in rows}


def test_awkward(spark):
    rows = [(1, None, None), (2, "u", ""), (3, None, "<p>"), (3, None, "<p>"), (None, "u", "<article><p>" + "one two three, four. " * 30 + "</p></article>"), (4, "u", "&#0;&bogus;<"), (5, "u", "\x00<a"), (6, "u", "<article><p>x</p>" * 2000)]
    pages = documents(spark, rows, ("page_id", "url", "html"), ("long", "string", "string"))
    got = main_text(pages)
    assert got.columns == ["id", "url", "text", "n_chars"]
    assert sorted((str(r["id"]), str(r["url"])) for r in got.collect()) == sorted((str(i), str(u)) for i, u, _ in rows)
    assert [r["text"] for r in got.where("id IN (1, 2, 3)").collect()] == [""] * 4
    assert main_text(documents(spark, [], ("page_id", "url", "html"), ("long", "string", "string"))).collect() == []


@pytest.mark.parametrize("part", ["<b>{}<p>x</p>", "<a {}", "<!x {}", "<span>{}</i>", "<i><p>{}<span>{}</i>", "<div>{}<li></li>", "<li><ul>{}<div>{}<li></li>", '<a x=">"{}', "<a ='{}", "<div>{}</section>"])
def test_time_grows_with_the_page(part):
    """Unclosed and stray tags: each opening or closing looks only at what it ends."""
    first, *rest = part.split("{}")
    pieces = [first, *rest]
    started = time.process_time()
    Page("".join(p * 60_000 for p in pieces if p))
    assert time.process_time() - started < 20


def test_tags_cut_off_by_the_end():
    page = Page("<p>one</p><p>two <a href='x")
    assert [t for t in page.text if t] == ["one", "two"]
    assert [t for t in Page("a<b").text if t] == ["a"]
    assert [t for t in Page("a < b").text if t] == ["a < b"]


def test_sampled_pages_are_those_of_lowest_hash(spark):
    from tideline.llm.html_text import sample_pages

    rows = [(i, f"<p>{i % 40}</p>") for i in range(60)] + [(None, "<p>n</p>"), (3, ""), (None, None)] + [(7, "<p>copied</p>")] * 80
    frame = spark.createDataFrame(rows, "id long, html string").selectExpr("id", "coalesce(html, '') AS html")
    hashed = frame.where("html <> ''").selectExpr("html", "xxhash64(id) AS h", "xxhash64(html) AS g").collect()
    want = [r["html"] for r in sorted(hashed, key=lambda r: (r["h"], r["g"]))]
    for n in (1, 10, 60, 100, 139, 500):
        assert sample_pages(frame, n) == want[:n]
    assert sample_pages(frame.where("id = -1"), 5) == []
