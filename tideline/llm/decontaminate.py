"""Benchmark decontamination by pigeonhole edit matching.

A passage of ``n`` characters may differ by ``k = n // 20`` edits.  Cut into ``k + 1``
pieces, at least one piece of every match is untouched; exact piece hits are found
in one scan, and the text around a hit is verified by Myers's bit-parallel distance.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import texts

PASSAGE = 128  # characters of a test item that are matched together
STEP = 64  # characters from one passage of an item to the next
ERRORS = 20  # one edit is allowed for so many characters
BLOCK_CHARS = 4_000_000  # characters of items that are searched at once; passages hold each about twice
SHORTEST = 20  # items of fewer characters match only whole words around them and without edits


def plain(text: str) -> str:
    """A-Z lower-cased, runs of ASCII white space one space, trimmed."""
    return b" ".join(text.encode("utf-8", "replace").lower().split()).decode()


def passages(text: str) -> list[str]:
    """Overlapping passages of ``PASSAGE`` characters, the last one at the end; of a shorter text the whole."""
    last = max(0, len(text) - PASSAGE)
    return [text[i : i + PASSAGE] for i in [*range(0, last, STEP), last]] if text else []


def pieces(passage: str) -> list[tuple[int, str]]:
    """``(offset, piece)`` of the error budget plus one pieces."""
    n = len(passage) // ERRORS + 1
    cuts = [len(passage) * i // n for i in range(n + 1)]
    return [(a, passage[a:b]) for a, b in zip(cuts, cuts[1:])]


def within(pattern: str, text: str, most: int) -> tuple[int, int] | None:
    """``(distance, end)`` of the best place of ``pattern`` in ``text``, if no more than ``most`` edits."""
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << len(pattern) - 1
    plus, minus, now = full, 0, len(pattern)
    best = None
    for at, c in enumerate(text):
        eq = masks.get(c, 0)
        xv = eq | minus
        xh = ((eq & plus) + plus ^ plus) | eq
        hp = minus | ~(xh | plus) & full
        hm = plus & xh
        if hp & top:
            now += 1
        elif hm & top:
            now -= 1
        hp, hm = hp << 1 & full, hm << 1 & full
        plus = hm | ~(xv | hp) & full
        minus = hp & xv
        if now <= most and (best is None or now < best[0]):
            best = (now, at + 1)
    return best


class Matcher:
    """Finds the passages of a block of items in documents."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.passages: list[tuple[int | None, str]] = []
        self.found = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            for p in passages(plain(text)):
                for offset, piece in pieces(p):
                    owners.setdefault(piece, []).append((len(self.passages), offset))
                self.passages.append((item, p))
        for piece, of in owners.items():
            self.found.add_word(piece, (len(piece), of))
        self.found.make_automaton()

    def matches(self, text: str) -> dict[int | None, tuple[int, int, int]]:
        """Best ``(edits, start, end)`` of each item in a plain text."""
        out: dict[int | None, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        if not self.passages or not len(self.found):
            return out
        for end, (size, owners) in self.found.iter(text):
            for n, offset in owners:
                item, p = self.passages[n]
                first = end + 1 - size - offset
                if (n, first) in tried or (item in out and out[item][0] == 0):
                    continue
                tried.add((n, first))
                most = len(p) // ERRORS
                if text.startswith(p, max(first, 0)) and first >= 0:
                    hit = (0, first, first + len(p))
                else:
                    low = max(0, first - most)
                    got = within(p, text[low : first + len(p) + most], most) if most else None
                    if got is None:
                        continue
                    stop = low + got[1]
                    back = within(p[::-1], text[max(0, stop - len(p) - most) : stop][::-1], most)
                    hit = (got[0], stop - (back[1] if back else len(p)), stop)
                if len(p) < SHORTEST and not ((hit[1] == 0 or text[hit[1] - 1] == " ") and (hit[2] == len(text) or text[hit[2]] == " ")):
                    continue
                out[item] = min(out.get(item, hit), hit)
        return out


_MATCHERS: dict[str, Matcher] = {}


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """``id, item_id, edits, start, end`` of every document that holds a passage of a test item, one row per pair.

    A passage is ``PASSAGE`` characters long and one begins every ``STEP``, so every
    quotation of ``PASSAGE + STEP - 1`` characters of an item holds a whole one,
    wherever it begins; an item of fewer than ``PASSAGE`` is one passage.  Texts are compared with A-Z lower-cased and white space runs as one space;
    ``start`` and ``end`` count characters of the text in that form.  Of several
    places the one with fewest edits, then the first, is told.  Null or empty texts
    and items match nothing.  Items of few characters must stand between spaces.
    Repeated rows are searched one by one, items that share an id count as one, as
    do those without an id, whose ``item_id`` is null; rows with a null id are found and keep it, empty tables give an empty result,
    other columns are ignored.

    The test items are a stated query set: they go to the tasks in blocks of about
    ``BLOCK_CHARS`` characters, each block against all documents.
    """
    rows = texts(docs, id_col, text_col)
    own = items.select(items[item_col].cast("long").alias("item"), F.coalesce(items["text"].cast("string"), F.lit("")).alias("text"))
    size = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + size // BLOCK_CHARS
    context, out = rows.sparkSession.sparkContext, None
    for b in range(blocks):
        part = own.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect()
        block = context.broadcast(sorted({(r["item"], r["text"]) for r in part}, key=lambda x: (x[0] is None, x[0] or 0, x[1])))

        def search(batches: Iterable[pd.DataFrame], block=block, key=uuid.uuid4().hex) -> Iterator[pd.DataFrame]:
            if key not in _MATCHERS:
                _MATCHERS.clear()
                _MATCHERS[key] = Matcher(block.value)
            matcher = _MATCHERS[key]
            for pdf in batches:
                found = [(i, item, *hit) for i, t in zip(pdf["id"], pdf["text"]) if t for item, hit in matcher.matches(plain(t)).items()]
                yield pd.DataFrame(found, columns=["id", "item_id", "edits", "start", "end"]).astype({"id": "Int64", "item_id": "Int64"})

        hits = rows.mapInPandas(search, "id long, item_id long, edits int, start int, end int")
        out = hits if out is None else out.union(hits)
    return out
