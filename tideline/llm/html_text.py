"""Main text of web pages: boosted trees over DOM nodes, decoded from the root down.

No page comes with labels, so the trees learn from variants of the corpus's own
pages whose parts are known: a bounded sample of pages is taken apart at its
semantic elements, and its parts are put together again under many other tags and
attribute names, with further boilerplate around and inside.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.boosting import Trees, fit_trees
from tideline.llm.common import frame
from tideline.llm.html_tree import Page, token_column

SAMPLE_PAGES = 150  # pages whose parts make the training pages: those whose ids hash lowest
VARIANTS = 6  # training pages made of each
TOKEN_COLUMNS = 96
TAGS = {t: n + 1 for n, t in enumerate(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody tr td th blockquote pre figure figcaption nav aside header footer form fieldset button select option menu address details summary dialog".split()
)}
GROUPS = {t: g for g, ts in enumerate(["nav menu", "aside", "header", "footer address", "form fieldset button select option dialog", "main article", "p blockquote pre", "h1 h2 h3 h4 h5 h6", "ul ol li dl dt dd"]) for t in ts.split()}
MARKS = str.maketrans("", "", "".join(c for c in map(chr, range(0x250)) if c not in ".,;:!?"))


def features(page: Page) -> np.ndarray:
    """Per node: tag, depth, sibling statistics, subtree densities, attribute tokens of itself and its ancestors."""
    n = len(page.tag)
    parent = np.array(page.parent)
    size = np.array([len(t) for t in page.text], float)
    link = np.array(page.links, float)
    inline = np.array(page.inline, float)
    marks = np.array([len(t.translate(MARKS)) if t else 0 for t in page.text], float)
    runs = (size > 0).astype(float)
    own = np.ones(n)
    depth = np.zeros(n)
    total = [x.copy() for x in (size, link, marks, runs, own, inline)]
    last = np.array(page.last)
    for x in total:  # nodes are in page order, so a subtree is a range
        sums = np.concatenate([[0.0], np.cumsum(x)])
        x[:] = sums[last + 1] - sums[np.arange(n)]
    text, links, punct, blocks, nodes, inlines = total
    children, place = np.zeros(n), np.zeros(n)
    group = np.zeros((n, 1 + max(GROUPS.values())))
    tokens = np.zeros((n, TOKEN_COLUMNS))
    for i in range(n):
        p = parent[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            place[i] = children[p]
            children[p] += 1
            group[i], tokens[i] = group[p], tokens[p]
        if page.tag[i] in GROUPS:
            group[i, GROUPS[page.tag[i]]] = 1
        for w in page.tokens[i]:
            tokens[i, token_column(w, TOKEN_COLUMNS)] = 1
    up = np.maximum(parent, 0)
    whole = max(text[0], 1)
    cols = [
        [TAGS.get(t, 0) for t in page.tag], np.array([TAGS.get(page.tag[p], 0) for p in up]), depth, place, children[up], children,
        np.log1p(text), links / np.maximum(text, 1), punct / np.maximum(text, 1), text / np.maximum(blocks, 1), text / np.maximum(nodes, 1),
        inlines / np.maximum(blocks, 1), text / whole, text / np.maximum(text[up], 1), links[up] / np.maximum(text[up], 1),
        np.log1p(text[up]), np.arange(n) / n, place / np.maximum(children[up], 1), size > 0,
    ]
    return np.column_stack([*cols, group, tokens]).astype(np.float32)


def decode(page: Page, logit: np.ndarray) -> list[str]:
    """The texts kept by the likeliest labelling in which nothing under a dropped node is kept."""
    n = len(page.tag)
    yes, no = -np.logaddexp(0, -logit), -np.logaddexp(0, logit)
    keep, drop = yes.tolist(), no.tolist()
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        keep[p] += max(keep[i], drop[i])
        drop[p] += drop[i]
    kept = [keep[0] >= drop[0]]
    for i in range(1, n):
        kept.append(kept[page.parent[i]] and keep[i] >= drop[i])
    return [t for t, k in zip(page.text, kept) if k and t]


# How other sites mark up the parts of a page: an opening, and a closing that fits.
BODY = ["<article>|</article>", "<main>|</main>", "<div class='content'>|</div>", "<div id='main'>|</div>", "<div class='post-content'>|</div>", "<div class='entry'>|</div>",
        "<section class='story'>|</section>", "<div>|</div>", "<main><article class='post'>|</article></main>", "<div class='article-body text'>|</div>", "<div id='page'><div class='main'>|</div></div>"]
MENU = ["<nav>|</nav>", "<div class='menu'>|</div>", "<div id='navigation'>|</div>", "<header>|</header>", "<ul class='nav'>|</ul>", "<div class='breadcrumb'>|</div>", "<div role='navigation'>|</div>", "<div class='topbar links'>|</div>"]
NOTE = ["<div class='ad'>|</div>", "<div class='ads banner'>|</div>", "<aside>|</aside>", "<aside class='sidebar'>|</aside>", "<div class='sidebar'>|</div>", "<div id='cookie-notice'>|</div>", "<div class='cookie consent'>|</div>",
        "<div class='notice'>|</div>", "<div class='promo sponsored'>|</div>", "<div class='advert advertisement'>|</div>", "<div class='related'>|</div>", "<div class='share social'>|</div>", "<div class='newsletter subscribe'>|</div>",
        "<header>|</header>", "<div class='header'>|</div>", "<div class='popup modal'>|</div>", "<section class='widget'>|</section>", "<div role='complementary'>|</div>"]
TALK = ["<div class='comments'>|</div>", "<section id='comments'>|</section>", "<div class='comment'>|</div>", "<ol class='comment-list'>|</ol>", "<div id='disqus' class='replies'>|</div>", "<section class='reader-comments discussion'>|</section>"]
FORM = ["<form>|</form>", "<form class='search'>|</form>", "<div class='login form'><form>|</form></div>", "<form id='contact'><fieldset>|</fieldset></form>"]
FOOT = ["<footer>|</footer>", "<div class='footer'>|</div>", "<div id='footer'>|</div>", "<div class='copyright legal'>|</div>", "<footer class='site-footer'>|</footer>"]
KEPT, GONE = "\ue000", "\ue001"  # what training text begins with


def _known_parts(source: str) -> tuple[list[tuple[str, str]], list[str]]:
    """Article blocks (tag, text) and other texts of a page that says which is which."""
    page = Page(source)
    inside = [False] * len(page.tag)
    blocks, rest = [], []
    for i in range(1, len(page.tag)):
        p = page.parent[i]
        inside[i] = inside[p] or page.tag[i] in ("article", "main")
        if page.text[i]:
            if inside[i]:
                blocks.append((page.tag[p] if page.tag[p] not in ("article", "main") else "p", page.text[i]))
            else:
                rest.append(page.text[i])
    return blocks, rest


def training_page(sources: list[str], rng: random.Random) -> str:
    """A page of known parts: every text begins with a mark that tells its label."""

    def clean(text: str, mark: str) -> str:
        return mark + text.replace("&", "&amp;").replace("<", "&lt;")

    def wrap(kind: list[str], inner: str) -> str:
        a, b = rng.choice(kind).split("|")
        return a + inner + b

    parts = [_known_parts(s) for s in sources]
    blocks = list(parts[0][0]) or [("p", t) for t in parts[0][1]]
    words = [w for _, rest in parts for t in rest for w in t.split()] or ["home", "about", "news"]
    pool = [t for bs, _ in parts[1:] for tag, t in bs if tag == "p"] or [" ".join(words[:20])]

    def sentence() -> str:
        text = rng.choice(pool).split()
        k = rng.randrange(max(1, len(text) - 5))
        return " ".join(text[k : k + rng.choice([3, 8, 15, 30, 60])])

    def items(n: int) -> str:
        return "<ul>" + "".join(f"<li><a href='/{k}'>{clean(' '.join(rng.choices(words, k=rng.choice([1, 1, 2, 3]))), GONE)}</a></li>" for k in range(n)) + "</ul>"

    def boiler() -> str:
        kind = rng.random()
        if kind < 0.25:
            return wrap(MENU, items(rng.randint(2, 12)))
        if kind < 0.6:
            body = clean(sentence(), GONE)
            return wrap(NOTE, rng.choice([body, f"<p>{body}</p>", f"<h3>{clean(rng.choice(words), GONE)}</h3>{items(4)}", f"<p>{body}</p><p>{clean(sentence(), GONE)}</p>"]))
        if kind < 0.8:
            return wrap(TALK, "".join(rng.choice(["<div class='comment'><p>{}</p></div>", "<p>{}</p>", "<li>{}</li>", "<div><b>{}</b></div>"]).format(clean(sentence(), GONE)) for _ in range(rng.randint(1, 6))))
        if kind < 0.9:
            return wrap(FORM, f"<label>{clean(rng.choice(words), GONE)}</label><input name='q'><button>{clean(rng.choice(words), GONE)}</button>")
        return wrap(FOOT, rng.choice([f"&copy; {clean(sentence(), GONE)}", f"<p>{clean(sentence(), GONE)}</p>", items(5)]))

    cut = rng.randrange(max(1, len(blocks) - 3)) if rng.random() < 0.5 else 0
    some = blocks[: 1 if blocks and blocks[0][0] == "h1" else 0] + blocks[cut : cut + rng.choice([1, 3, 8, 20])]
    body, inner = "", rng.random() < 0.3
    for tag, text in some:
        tag = tag if rng.random() < 0.8 else rng.choice(["p", "li", "blockquote", "div", "h2", "td"])
        open_, close = {"li": ("<ul><li>", "</li></ul>"), "td": ("<table><tr><td>", "</td></tr></table>")}.get(tag, (f"<{tag}>", f"</{tag}>"))
        body += open_ + ("<b>" if rng.random() < 0.1 else "") + clean(text, KEPT) + close
        if inner and rng.random() < 0.2:
            body += boiler()
    above = "".join(boiler() for _ in range(rng.randint(0, 4)))
    below = "".join(boiler() for _ in range(rng.randint(0, 4)))
    return f"<html><head><title>x</title></head><body>{above}{wrap(BODY, body)}{below}</body></html>"


def learn(sources: list[str], seed: int = 11) -> Trees:
    """Trees for whether a node holds main text, from pages put together of ``sources``."""
    rng = random.Random(seed)
    sources = sources or ["<body><article><h1>a b</h1><p>one two three</p></article></body>"]
    x, y = [], []
    for k in range(VARIANTS * len(sources)):
        page = Page(training_page([sources[k % len(sources)], *rng.choices(sources, k=2)], rng))
        good = np.array([t.startswith(KEPT) or f" {KEPT}" in t for t in page.text], float)
        page.text = [t.replace(KEPT, "").replace(GONE, "") for t in page.text]
        sums = np.concatenate([[0.0], np.cumsum(good)])
        label = (sums[np.array(page.last) + 1] - sums[np.arange(len(good))]) > 0
        x.append(features(page))
        y.append(label)
    return fit_trees(np.concatenate(x), np.concatenate(y).astype(float))


def sample_pages(rows: DataFrame, n: int) -> list[str]:
    """The ``n`` pages of ``rows (id, html)`` whose hashes are lowest, in that order; empty ones are left out.

    Tasks send hashes only; then no more than ``n`` pages are fetched.  Pages that
    tie at the last place are copies, and one of them stands for all.
    """
    filled = rows.where("html <> ''").select("html", F.xxhash64("id").alias("h"), F.xxhash64("html").alias("g"))
    lowest = [tuple(r) for r in filled.select("h", "g").orderBy("h", "g").limit(n).collect()]
    if not lowest:
        return []
    h, g = lowest[-1]
    last = (F.col("h") == h) & (F.col("g") == g)
    below = sorted((r["h"], r["g"], r["html"]) for r in filled.where((F.col("h") < h) | (F.col("h") == h) & (F.col("g") < g)).collect())
    tied = filled.where(last).select("html").first()["html"]
    return [html for *_, html in below] + [tied] * lowest.count((h, g))


def main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` of every row; ``text`` is empty where no main text is found.

    Blocks (elements laid out on their own, and runs of text between them) are
    joined by two line breaks in page order; white space inside one is one space.  A null
    html counts as empty; broken markup is read as browsers do for unclosed and
    stray tags.  Repeated rows are read one by one, a null id stays null, an empty
    table gives an empty result, other columns are ignored.
    """
    source = F.coalesce(pages[html_col].cast("string"), F.lit(""))
    rows = pages.select(pages[id_col].cast("long").alias("id"), pages["url"].cast("string").alias("url"), source.alias("html"))
    trees = rows.sparkSession.sparkContext.broadcast(learn(sample_pages(rows, SAMPLE_PAGES)))

    def extract(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for k in range(0, len(pdf), 200):
                part = pdf.iloc[k : k + 200]
                read = [Page(s) for s in part["html"]]
                rows_of = [features(p) for p in read]
                logit = trees.value.logit(np.concatenate(rows_of))
                cuts = np.cumsum([len(r) for r in rows_of])[:-1]
                yield frame({"id": part["id"].astype("Int64"), "url": part["url"], "text": ["\n\n".join(decode(p, z)) for p, z in zip(read, np.split(logit, cuts))]})

    return rows.mapInPandas(extract, "id long, url string, text string").withColumn("n_chars", F.length("text").cast("long"))
