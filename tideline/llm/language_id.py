"""Language identification by n-gram filters that answer for all languages at once.

Each language has a Bloom filter of the letter n-grams it contains.  The filters are
stored bit-sliced: a slot holds one bit per language, so the slots of an n-gram, combined
by AND, are the mask of languages that contain it.  A text's n-grams are counted per
language, the counts are corrected for each filter's false positives, and the largest wins.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import frame, mix, stage, summed_blocks

LENGTHS = (3, 4)  # letters of an n-gram; the first and last may be a word's edge
FREQUENT = 5e-6  # least share of a language's n-grams: no language has more than its inverse
TYPICAL = 0.25  # a language contains an n-gram if it is at least this frequent there, of where it is most frequent
HASHES = 4
SLOTS_EACH = 16  # slots for each n-gram of the language that has most
PIECE = 1 << 19  # code points that a task looks at together
HELD = 1 << 21  # counts that a task keeps before it sends them
BLOCKS = 64
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    """Whether a code point is a letter or a mark on one."""
    if not _LETTER:
        _LETTER.append(np.fromiter((unicodedata.category(chr(c))[0] in "LM" for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Code points of lower-cased texts between edges, the text each belongs to, and how many may start an n-gram."""
    some: list[np.ndarray] = []
    of: list[int] = []

    def joined() -> tuple[np.ndarray, np.ndarray, int]:
        points = np.concatenate(some)
        return points, np.repeat(of, [len(x) for x in some]), len(points)

    held = 0
    for k, t in enumerate(texts):
        own = f"\0{t.lower()}\0"
        if len(own) > PIECE:
            for i in range(0, len(own), PIECE):
                points = _points(own[i : i + PIECE + max(LENGTHS) - 1])
                yield points, np.full(len(points), k), PIECE
            continue
        some.append(_points(own))
        of.append(k)
        held += len(own)
        if held >= PIECE:
            yield joined()
            some, of, held = [], [], 0
    if some:
        yield joined()


def ngrams(points: np.ndarray, of: np.ndarray, starts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all n-grams and the texts they belong to; only an n-gram's ends may be no letters."""
    letter = letter_table()[points]
    points = np.where(letter, points, 0).astype(np.uint64)
    for n in LENGTHS:
        count = min(len(points) - n + 1, starts)
        if count <= 0:
            continue
        good = letter[1 : 1 + count].copy()
        for j in range(2, n - 1):
            good &= letter[j : j + count]
        at = np.flatnonzero(good)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + points[at + j]
        yield mix(h), of[at]


def _summed(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, place = np.unique(np.concatenate(grams), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts)).astype(np.int64)


def gram_counts(rows: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all of ``rows (lang, text)``; tasks add up first."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, tuple[list, list]] = {}
        held = 0

        def told() -> Iterator[pa.RecordBatch]:
            for lang, own in found.items():
                grams, counts = _summed(*own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in set(langs):
                for piece in pieces([t for t, own in zip(texts, langs) if own == lang]):
                    for grams, _ in ngrams(*piece):
                        if len(grams):
                            distinct, counts = np.unique(grams, return_counts=True)
                            own = found.setdefault(lang, ([], []))
                            own[0].append(distinct)
                            own[1].append(counts)
                            held += len(distinct)
            if held > HELD:
                found = {lang: tuple([x] for x in _summed(*own)) for lang, own in found.items()}
                held = sum(len(own[0][0]) for own in found.values())
                if held > HELD // 2:
                    yield from told()
                    found, held = {}, 0
        yield from told()

    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _slots(grams: np.ndarray, slots: int) -> list[np.ndarray]:
    first, step = grams & np.uint64(0xFFFFFFFF), grams >> np.uint64(32) | np.uint64(1)
    return [((first + np.uint64(j) * step) & np.uint64(slots - 1)).astype(np.int64) for j in range(HASHES)]


class Languages:
    """``table[slot]`` is a mask of ``names``, in words of ``table``'s type; most n-grams first."""

    def __init__(self, names: list[str], table: np.ndarray):
        self.names, self.table = names, table
        width = table.dtype.itemsize * 8
        self.where = [(k // width, table.dtype.type(1 << k % width)) for k in range(len(names))]
        full = [np.count_nonzero(table[:, w] & bit) / len(table) for w, bit in self.where]
        self.false = np.array(full) ** HASHES  # how often an n-gram that is not in a filter seems to be

    def contained(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For each text, how many n-grams each language is estimated to contain, and the number of n-grams."""
        hits, total = np.zeros((len(texts), len(self.names))), np.zeros(len(texts))
        for piece in pieces(texts):
            for grams, of in ngrams(*piece):
                masks = None
                for at in _slots(grams, len(self.table)):
                    masks = self.table[at] if masks is None else masks & self.table[at]
                total += np.bincount(of, minlength=len(texts))
                for k, (w, bit) in enumerate(self.where):
                    hits[:, k] += np.bincount(of[masks[:, w] & bit != 0], minlength=len(texts))
        return np.maximum((hits - total[:, None] * self.false) / np.maximum(1 - self.false, 1e-9), 0), total

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The language that contains most of each text and its share of all languages' n-grams; ties: the larger language."""
        own, _ = self.contained(texts)
        best, total = own.argmax(1), own.sum(1)
        share = np.where(total > 0, own.max(1) / np.maximum(total, 1e-9), 1 / len(self.names))
        known = [has_letter(t) for t in texts]
        return [self.names[b] if k else UNKNOWN for b, k in zip(best, known)], np.where(known, share, 0.0)


def learn(rows: DataFrame) -> Languages | None:
    """Filters of all languages of ``rows (lang, text)``; None if no row has a letter."""
    counts = stage(gram_counts(rows), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    ranked = totals.orderBy(F.desc("total"), "lang").collect()
    names = [r["lang"] for r in ranked]
    if not names:
        return None
    width = next((w for w in (8, 16, 32) if len(names) <= w), 64)
    words = -(-len(names) // width)
    place = rows.sparkSession.createDataFrame([(r["lang"], k, r["total"]) for k, r in enumerate(ranked)], "lang string, place int, total long")
    share = counts.join(place, "lang").select("gram", "place", (F.col("n") / F.col("total")).alias("share")).where(F.col("share") >= FREQUENT)
    top = share.groupBy("gram").agg(F.max("share").alias("top"), F.collect_list(F.struct("place", "share")).alias("of"))
    typical = F.transform(F.filter("of", lambda x: x["share"] >= TYPICAL * F.col("top")), lambda x: x["place"])
    grams = stage(top.select("gram", typical.alias("places")), "typical")
    most = grams.select(F.explode("places").alias("p")).groupBy("p").count().agg(F.max("count")).first()[0] or 1
    slots = 1 << max(10, (SLOTS_EACH * most - 1).bit_length())
    kind = np.dtype(f"uint{width}")

    def fill(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros((slots, words), kind)
        for pdf in batches:
            of = np.repeat(np.arange(len(pdf)), [len(p) for p in pdf["places"]])
            places = np.concatenate([*pdf["places"], np.zeros(0, np.int64)]).astype(np.int64)
            masks = np.zeros((len(pdf), words), kind)
            np.bitwise_or.at(masks, (of, places // width), kind.type(1) << (places % width).astype(kind))
            for at in _slots(pdf["gram"].to_numpy(np.int64).view(np.uint64), slots):
                np.bitwise_or.at(table, at, masks)
        for b, part in enumerate(np.split(table, BLOCKS)):
            yield frame({"block": [b], "data": [part.tobytes()]})

    table = summed_blocks(grams.mapInPandas(fill, "block int, data binary"), slots * words, kind.name, np.bitwise_or)
    return Languages(names, table.reshape(slots, words))


def identify(docs: DataFrame, learnt: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id, lang_pred, score`` of every row, learnt from the rows of ``docs`` where ``learnt`` holds and the language is not null.

    Letters are Unicode letters and marks, lower-cased.  A text that is null or has no
    letter is ``und`` with score 0, as is every text where nothing could be learnt; an
    empty table gives an empty result.  A text none of whose n-grams is known goes to the language
    with most n-grams, with an equal share as its score; that language wins ties as well.
    Repeated rows are judged alike and count each time; a null id stays null; other
    columns are ignored.  The filters have at most ``2 * SLOTS_EACH / FREQUENT`` slots of one bit per
    language, whatever the corpus.
    """
    train = docs.where(learnt & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    languages = learn(train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")))
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    if languages is None:
        return rows.select("id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    known = rows.sparkSession.sparkContext.broadcast(languages)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score = known.value.predict([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(score)], ["id", "lang_pred", "score"])

    return rows.mapInArrow(judge, "id long, lang_pred string, score double")
