"""Pages as flat trees of block elements and runs of text."""

from __future__ import annotations

import html
import re
import zlib
from collections import Counter

#: Elements that HTML lays out as blocks of their own (fixed values of the standard's rendering section).
BLOCK = frozenset(
    "html body address article aside blockquote button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements without an end tag, and elements whose content is no page text (fixed values of the standard).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = "script|style|template|noscript|iframe|object|canvas|audio|video|textarea|title"
#: Hidden elements of other vocabularies, the only ones that a slash before the end of the start tag closes.
FOREIGN = "svg|math"
#: What a start tag ends when it is open: the start tags, and the elements they end.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("table td th button ul ol dl body html".split())

# What is inside a tag: a quote delimits only right after "=", and a value without quotes ends at white space.
# The slash just before ">" is left over, unless it belongs to such a value.  A tag that the page's end cuts off
# is no tag and no text, as in browsers.
_ATTRS = r"(?:[^>=/]++|/(?!>)|=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s>\"'][^\s>]*+)?)*+"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{HIDDEN})(?=[\s/>]){_ATTRS}/?>.*?(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<foreign>{FOREIGN})(?=[\s/>]){_ATTRS}(?:/>|>.*?(?:</(?P=foreign)\s*>|\Z))"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS}/?)(?:>|(?P<cut>\Z))",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_WORD = re.compile(r"[a-z]+")


class Page:
    """Nodes in page order: ``tag`` (empty for text), ``parent``, ``tokens`` of the attributes, ``text``, ``links`` (characters in links), ``last`` (end of the subtree)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.tokens, self.text, self.links, self.inline = ["#page"], [-1], [()], [""], [0], [0]
        self.stack: list[tuple[str, int]] = [("#page", 0)]
        # So that no open or close walks past what it does not end: depths of the blocks, how many elements
        # of a name are open, inline ones by block, and blocks by the scope that they stand in.
        self.blocks = [0]
        self.open_blocks: Counter = Counter()
        self.inlines: list[Counter] = [Counter()]
        self.scopes: list[tuple[int, Counter]] = [(0, Counter())]
        self.run: list[str] = []
        self.run_links = self.run_inline = self.in_link = 0
        at = 0
        for m in _TOKEN.finditer(source):
            if m.start() > at:
                self.add_text(source[at : m.start()])
            at = m.end()
            if m["tag"] and m["cut"] is None:
                (self.close if m["end"] else self.open)(m["tag"].lower(), m["attrs"])
        if at < len(source):
            self.add_text(source[at:])
        self.flush()
        self.last = list(range(len(self.tag)))
        for i in range(len(self.tag) - 1, 0, -1):
            p = self.parent[i]
            self.last[p] = max(self.last[p], self.last[i])

    def add_text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.run.append(text)
        if self.in_link:
            self.run_links += len(text)

    def top(self) -> int:
        return self.stack[self.blocks[-1]][1]

    def flush(self) -> None:
        """What text there is since the last block boundary becomes a node."""
        if self.run:
            text = " ".join("".join(self.run).split())
            if text:
                self.put("", (), text)
                self.links[-1], self.inline[-1] = min(self.run_links, len(text)), self.run_inline
            self.run = []
        self.run_links = self.run_inline = 0

    def put(self, tag: str, tokens: tuple, text: str) -> int:
        self.parent.append(self.top())
        self.tag.append(tag)
        self.tokens.append(tokens)
        self.text.append(text)
        self.links.append(0)
        self.inline.append(0)
        return len(self.tag) - 1

    def pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, node = self.stack.pop()
            if node < 0:
                self.inlines[-1][tag] -= 1
                if tag == "a":
                    self.in_link = max(0, self.in_link - 1)
                continue
            self.blocks.pop()
            self.inlines.pop()
            if self.scopes[-1][0] == len(self.stack):
                self.scopes.pop()
            self.open_blocks[tag] -= 1
            self.scopes[-1][1][tag] -= 1

    def end_open(self, tag: str) -> None:
        """End the block that this start tag ends, if one is open in the same scope."""
        ended = ENDS.get(tag)
        if ended is None:
            if self.stack[self.blocks[-1]][0] == "p" and tag not in ("html", "body"):
                self.pop_to(self.blocks[-1])
            return
        scope, there = self.scopes[-1]
        if any(there[t] > 0 for t in ended):
            self.pop_to(next(d for d in reversed(self.blocks) if self.stack[d][0] in ended))
        elif self.stack[scope][0] in ended:
            self.pop_to(scope)

    def open(self, tag: str, attrs: str) -> None:
        if tag == "head":  # what may stand in it is hidden or void; anything else ends it, with or without its end tag
            return
        if tag not in BLOCK:
            if tag == "br":
                self.run.append(" ")
            elif tag not in VOID and not attrs.endswith("/"):
                self.stack.append((tag, -1))
                self.inlines[-1][tag] += 1
                self.in_link += tag == "a"
                self.run_inline += 1
            return
        self.flush()
        self.end_open(tag)
        if tag == "hr" or (tag in ("html", "body") and self.open_blocks[tag] > 0):
            return
        found = _NAMED.findall(attrs) if attrs else ()
        node = self.put(tag, tuple(dict.fromkeys(w for x in found for w in _WORD.findall(x.lower()))), "")
        self.scopes[-1][1][tag] += 1
        self.open_blocks[tag] += 1
        self.blocks.append(len(self.stack))
        self.inlines.append(Counter())
        if tag in SCOPE:
            self.scopes.append((len(self.stack), Counter()))
        self.stack.append((tag, node))

    def close(self, tag: str, _: str) -> None:
        if tag in BLOCK:
            if self.open_blocks[tag] > 0:
                self.flush()
                self.pop_to(next(d for d in reversed(self.blocks) if self.stack[d][0] == tag))
        elif self.inlines[-1][tag] > 0:
            depth = len(self.stack) - 1
            while self.stack[depth][0] != tag:
                depth -= 1
            self.pop_to(depth)


def token_column(word: str, columns: int) -> int:
    return zlib.crc32(word.encode()) % columns
