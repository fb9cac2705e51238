"""The best documents for each of many queries, with sums that queries share taken once.

A document's score for an item is a sum of one number for each of the item's terms, so
items that hold the same terms share partial sums.  Shared sets are mined among the
items of a block: the pair of terms (or of sets found before) that most items hold
becomes a set of its own, again and again.  That gives a graph in which each set is the sum of two
others and each item the sum of what is left of it.  Tasks keep a vector for each shared
set over a batch of documents, compute it once, and add it to all that hold it.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import stage

BLOCK_ENTRIES = 50_000  # about so many pairs of item and term are searched for together
BATCH_CELLS = 1 << 22  # vectors times documents that a task holds at once
NEAR = 64  # a term is paired with so many neighbours in an item, in the order of how many items hold them
NO_ID = np.iinfo(np.int64).max

# Terms are runs of ASCII letters and digits and of all other characters beyond ASCII; only A-Z are lower-cased.
_TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


@dataclass
class Sharing:
    """``sets[i]`` is the pair of symbols whose sum is symbol ``leaves + i``; ``items[k]`` lists an item's symbols."""

    leaves: int
    sets: list[tuple[int, int]]
    items: list[list[int]]


def share_sums(items: list[set[int]], leaves: int) -> Sharing:
    """Mine sets of symbols that several items hold; every item stays the disjoint union of its symbols."""
    items = [set(s) for s in items]
    holders: dict[int, set[int]] = defaultdict(set)
    for k, symbols in enumerate(items):
        for x in symbols:
            holders[x].add(k)
    sets: list[tuple[int, int]] = []

    def merge(a: int, b: int, both: set[int]) -> int:
        new = leaves + len(sets)
        sets.append((a, b))
        for k in both:
            items[k] -= {a, b}
            items[k].add(new)
        holders[a] -= both
        holders[b] -= both
        holders[new] = both
        return new

    # Symbols that exactly the same items hold need no pairing.
    alike: dict[frozenset, list[int]] = defaultdict(list)
    for x in sorted(holders):
        if len(holders[x]) > 1:
            alike[frozenset(holders[x])].append(x)
    for both, symbols in alike.items():
        one = symbols[0]
        for x in symbols[1:]:
            one = merge(one, x, set(both))

    def order(k: int) -> list[int]:
        return sorted((x for x in items[k] if len(holders[x]) > 1), key=lambda x: (-len(holders[x]), x))

    pairs: Counter = Counter()
    for k in range(len(items)):
        own = order(k)
        for i, x in enumerate(own):
            pairs.update((min(x, y), max(x, y)) for y in own[i + 1 : i + 1 + NEAR])
    heap = [(-n, p) for p, n in pairs.items() if n > 1]
    heapq.heapify(heap)
    while heap:
        n, (a, b) = heapq.heappop(heap)
        both = holders[a] & holders[b]
        if len(both) < 2:
            continue
        if len(both) < -n:  # counted before other merges took some of it
            heapq.heappush(heap, (-len(both), (a, b)))
            continue
        new = merge(a, b, both)
        beside: Counter = Counter()
        for k in both:
            beside.update(order(k)[:NEAR])
        for x, m in beside.items():
            if x != new and m > 1:
                heapq.heappush(heap, (-m, (x, new)))
    return Sharing(leaves, sets, [sorted(s) for s in items])


@dataclass
class Block:
    """Items searched for together; ``keys`` are their ids, ``symbols`` the distinct (term, repeats)."""

    keys: list
    terms: dict[bytes, int]
    symbols: list[tuple[int, int]]
    sharing: Sharing

    @classmethod
    def of(cls, rows: list[tuple[object, str]]) -> Block:
        found: dict[object, Counter] = defaultdict(Counter)
        for key, text in rows:
            found[key].update(terms_of(text))
        keys = sorted(found, key=lambda k: (k is None, 0 if k is None else k))
        terms: dict[bytes, int] = {}
        symbols: dict[tuple[int, int], int] = {}
        items = []
        for key in keys:
            own = [(terms.setdefault(t, len(terms)), n) for t, n in sorted(found[key].items())]
            items.append({symbols.setdefault(s, len(symbols)) for s in own})
        return cls(keys, terms, list(symbols), share_sums(items, len(symbols)))


def _vectors(docs: DataFrame, terms: dict[bytes, int]) -> DataFrame:
    """Length and query terms of every document that has terms: ``id, n, terms, times``."""
    known = docs.sparkSession.sparkContext.broadcast(terms)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = known.value
        for batch in batches:
            ids, sizes, which, times = [], [], [], []
            for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                found = terms_of(t)
                if found:
                    own = [(place[w], n) for w, n in Counter(found).items() if w in place]
                    ids.append(i)
                    sizes.append(len(found))
                    which.append([x for x, _ in own])
                    times.append([n for _, n in own])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(which, pa.list_(pa.int32())), pa.array(times, pa.list_(pa.int64()))],
                ["id", "n", "terms", "times"],
            )

    return stage(docs.mapInArrow(read, "id long, n long, terms array<int>, times array<long>"), "vectors")


class Best:
    """The best documents of each item so far: highest score, then smallest id."""

    def __init__(self, items: int, most: int):
        self.most = most
        self.scores = [np.zeros(0, np.int64) for _ in range(items)]
        self.ids = [np.zeros(0, np.int64) for _ in range(items)]
        self.least = np.ones(items, np.int64)  # a score below this is out

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.least[item])
        if not len(at):
            return
        scores, ids = np.concatenate([self.scores[item], scores[at]]), np.concatenate([self.ids[item], ids[at]])
        order = np.lexsort((ids, -scores))[: self.most]
        self.scores[item], self.ids[item] = scores[order], ids[order]
        if len(order) == self.most:
            self.least[item] = scores[order[-1]]


def score_batch(block: Block, weights: np.ndarray, m: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray, best: Best, ids: np.ndarray) -> None:
    """Score a batch of documents; ``doc, term, times`` are its cells, ``m`` the documents' length terms."""
    docs = len(m)
    parts = weights[term] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
    by_term = np.argsort(term, kind="stable")
    term, doc, parts = term[by_term], doc[by_term], parts[by_term]
    bounds = np.searchsorted(term, np.arange(len(weights) + 1))
    sharing = block.sharing
    sums: list[np.ndarray | None] = []  # of the sets, in the order in which they were found

    def add(to: np.ndarray, symbol: int) -> None:
        if symbol >= sharing.leaves:
            if (own := sums[symbol - sharing.leaves]) is not None:
                to += own
            return
        t, repeats = block.symbols[symbol]
        if bounds[t] < bounds[t + 1]:
            to[doc[bounds[t] : bounds[t + 1]]] += repeats * parts[bounds[t] : bounds[t + 1]]

    def empty(symbol: int) -> bool:
        if symbol >= sharing.leaves:
            return sums[symbol - sharing.leaves] is None
        t = block.symbols[symbol][0]
        return bounds[t] == bounds[t + 1]

    for a, b in sharing.sets:
        if empty(a) and empty(b):
            sums.append(None)
            continue
        own = np.zeros(docs, np.int64)
        add(own, a)
        add(own, b)
        sums.append(own)
    for k, symbols in enumerate(sharing.items):
        own = np.zeros(docs, np.int64)
        for s in symbols:
            add(own, s)
        best.add(k, own, ids)


def _search(docs: DataFrame, block: Block, most: int) -> DataFrame:
    """``item`` (place in the block), ``id`` and ``score`` of each item's best documents, ranked."""
    spark = docs.sparkSession
    vectors = _vectors(docs, block.terms)
    total = vectors.agg(F.count("*").alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    df = np.zeros(len(block.terms), np.int64)
    for r in vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # no more rows than the block has terms
        df[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * total["N"] + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    shared = spark.sparkContext.broadcast((block, weights))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, weights = shared.value
        best = Best(len(block.keys), most)
        step = max(1, BATCH_CELLS // (len(block.sharing.sets) + 1))
        for whole in batches:
            for k in range(0, len(whole), step):
                batch = whole.slice(k, step)
                ids = np.array([NO_ID if i is None else i for i in batch.column("id").to_pylist()], np.int64)
                m = np.array([75 + 25 * n * total["N"] // total["L"] for n in batch.column("n").to_pylist()], np.int64)
                which, times = batch.column("terms"), batch.column("times")
                doc = np.repeat(np.arange(len(batch)), np.diff(which.offsets.to_numpy()))
                score_batch(block, weights, m, doc, which.flatten().to_numpy().astype(np.int64), times.flatten().to_numpy(), best, ids)
        for item, (scores, ids) in enumerate(zip(best.scores, best.ids)):
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), item, np.int32)), pa.array([None if i == NO_ID else i for i in ids.tolist()], pa.int64()), pa.array(scores)],
                    ["item", "id", "score"],
                )

    found = vectors.mapInArrow(search, "item int, id long, score long")
    # Each task tells its best; they are thinned in groups before all of an item meet.
    some = found.withColumn("group", F.spark_partition_id() % 64)
    rank = "row_number() OVER (PARTITION BY item{} ORDER BY score DESC, id ASC NULLS LAST)"
    thinned = some.withColumn("rank", F.expr(rank.format(", group"))).where(F.col("rank") <= most).drop("group")
    return thinned.withColumn("rank", F.expr(rank.format(""))).where(F.col("rank") <= most)


def ranked_search(
    docs: DataFrame, items: DataFrame, most: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """``item_id, rank, id, score`` of the ``most`` best documents of every item; fewer if fewer have a score above 0.

    Rows of one item id are one item with all their terms; rows with a null id are
    one, too.  A null text has no terms, and neither documents nor items without
    terms are found or counted.  Each row of the documents is ranked for itself, repeated ones
    too; equal scores are in the order of ids, a null id last.  Empty tables give an empty
    result; other columns are ignored.  Ids are 64-bit numbers.

    The items are a stated query set.  They go to the tasks in blocks of about ``BLOCK_ENTRIES``
    terms, each block against all documents: one pass over the texts, one over their
    query terms.  A task holds the best of each item and the vectors of a batch of documents.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    own = items.select(items[item_col].cast("long").alias("item"), F.coalesce(items[item_text_col].cast("string"), F.lit("")).alias("text"))
    size = own.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))), F.lit(0))).first()[0]
    blocks = 1 + size // BLOCK_ENTRIES
    out = spark.createDataFrame([], "item_id long, rank int, id long, score long")
    for b in range(blocks):
        part = own.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()
        block = Block.of([(r["item"], r["text"]) for r in part])
        if block.terms:
            names = spark.createDataFrame(list(enumerate(block.keys)), "item int, item_id long")
            found = _search(rows, block, most).join(F.broadcast(names), "item")
            out = out.union(found.select("item_id", F.col("rank").cast("int"), "id", "score"))
    return out
