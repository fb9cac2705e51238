"""Jaccard join of word-shingle sets with adaptive multi-match prefixes, as connected classes.

Shingles have one order for all documents: ascending by how often a sketch of the
whole corpus has seen them, then by hash.  Two sets of
the wanted similarity share at least ``l`` of the first ``size - needed + l``.  Each
document takes the ``l`` that its estimated candidates make cheapest, and a pair
must share as many tokens as the smaller ``l`` of the two says.

Equal sets are one node.  Candidates of different classes that sizes and parity sketches
allow are all verified on their sets; members of a class that is already linked are not
compared with each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import SPACE, components, forget, frame, mix, numbered, stage, summed_blocks, texts

COUNTERS = 1 << 20  # cells of the frequency sketch
BLOCKS = 64
MOST_SHARED = 4  # longest multi-match that a document considers
TURNS = 2  # rounds of picked pairs before all others are compared
VERIFY_COST = 8.0  # of a candidate, in units of one prefix match
BITS = 8  # 64-bit words of a set's parity sketch
WIDE_BITS = 64  # those of the second sketch of a set that is too large for the first
FILTER_BITS = (1 << 20, 1 << 29)  # least and most bits of the filter of documents to read again
PART_BYTES = 1 << 20  # of a text that are hashed at a time, to the end of the word
PLACES = 64  # in a word whose bytes have ready hashes
SEED = np.uint64(0x9E3779B97F4A7C15)
READY = mix(np.arange(PLACES << 8, dtype=np.uint64) + SEED)
BLANK = re.compile(rb"[\x20\x09-\x0D]")
INSIDE = ~np.isin(np.arange(256), list(SPACE.encode()))


def _word_hashes(raw: np.ndarray) -> np.ndarray:
    own = np.flatnonzero(INSIDE[raw])
    if not len(own):
        return np.zeros(0, np.uint64)
    first = np.flatnonzero(np.diff(own, prepend=-2) > 1)
    size = np.diff(first, append=len(own))
    byte = (np.arange(len(own)) - np.repeat(first, size)) << 8 | raw[own]
    return mix(np.add.reduceat(READY[byte] if size.max() <= PLACES else mix(byte.astype(np.uint64) + SEED), first))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each lower-case (A-Z) word between ASCII white space: the sum over its bytes of what byte and place hash to."""
    data = text.encode("utf-8", "surrogatepass").lower()
    if len(data) <= PART_BYTES:
        return _word_hashes(np.frombuffer(data, np.uint8))
    parts, at = [], 0
    while at < len(data):
        cut = BLANK.search(data, at + PART_BYTES)
        end = cut.end() if cut else len(data)
        parts.append(_word_hashes(np.frombuffer(data, np.uint8, end - at, at)))
        at = end
    return np.concatenate(parts)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; of all its words if they are fewer."""
    h = word_hashes(text)
    n = len(h)
    if not n:
        return h
    w = min(n, width)
    total = np.full(n - w + 1, w, np.uint64)
    for j in range(w):
        total = total * SEED + h[j : n - w + 1 + j]
    s = np.sort(mix(total))
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def parity(s: np.ndarray, size: int = BITS) -> np.ndarray:
    """Bit ``h mod (64 size)`` flips with each element: two sketches differ in no more bits than the sets in elements."""
    odd = np.bincount((s & np.uint64(64 * size - 1)).astype(np.int64), minlength=64 * size) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_from(percent: int) -> int:
    """The size from which the small sketch, of which at most about half the bits differ, tells hardly any sets apart."""
    return 64 * BITS * (100 + percent) // max(5 * (100 - percent), 1)


def needed(n, percent: int):
    """Least overlap of a set of ``n`` with any set that is similar enough."""
    return -(-percent * n // 100)


def prefix(s: np.ndarray, sketch: np.ndarray, noise: float, percent: int) -> tuple[np.ndarray, int]:
    """The tokens a set is indexed under, rarest first, and how many of them a partner must share."""
    n = len(s)
    must = needed(n, percent)
    count = sketch[s % np.uint64(COUNTERS)].astype(np.float64)
    rank, most = count.astype(np.uint64) << np.uint64(32) | s >> np.uint64(32), n - must + min(MOST_SHARED, must)
    low = np.flatnonzero(rank <= np.partition(rank, most - 1)[most - 1])  # ties are kept, so the order below is that of all
    order = low[np.argsort(rank[low], kind="stable")][:most]
    others = np.cumsum(np.maximum(count[order] - noise, 0))
    first = n - must
    costs = [(others[first + k - 1] * (1 + VERIFY_COST / k), k) for k in range(1, min(MOST_SHARED, must) + 1)]
    share = min(costs)[1]
    return s[order[: first + share]], share


def _read(rows: DataFrame, width: int, percent: int) -> DataFrame:
    """One pass: size, signature and parity sketches of every set, and each task's counters."""
    long = wide_from(percent)
    sketch = ", ".join(f"b{k} long" for k in range(BITS))

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters = np.zeros(COUNTERS, np.int32)
        empty = np.zeros(BITS, np.int64)
        for pdf in batches:
            sizes, signs, bits, wide, cells = [], [], [], [], [np.zeros(0, np.int64)]
            for t in pdf["text"]:
                s = shingles(t, width)
                cells.append((s % np.uint64(COUNTERS)).astype(np.int64))
                sizes.append(len(s))
                signs.append(xxhash.xxh3_128_digest(s.tobytes()))
                bits.append(parity(s) if len(s) else empty)
                wide.append(parity(s, WIDE_BITS) if len(s) >= long else None)
            counters += np.bincount(np.concatenate(cells), minlength=COUNTERS).astype(np.int32)
            b = np.array(bits, np.int64).reshape(-1, BITS)
            yield frame({"id": pdf["id"].astype("Int64"), "n": np.array(sizes, np.int64), "sign": signs, **{f"b{k}": b[:, k] for k in range(BITS)}, "wide": wide, "block": -1, "data": None})
        for k, part in enumerate(np.split(counters, BLOCKS)):
            yield frame({"id": pd.array([None], "Int64"), "n": [0], "sign": [b""], **{f"b{j}": [0] for j in range(BITS)}, "wide": None, "block": [k], "data": [part.tobytes()]})

    return stage(rows.mapInPandas(read, f"id long, n long, sign binary, {sketch}, wide array<long>, block int, data binary"), "sets")


def _indexed(rows: DataFrame, sketch: np.ndarray, noise: float, width: int, percent: int) -> DataFrame:
    """``token, sign, id, share, place`` of every set's prefix; a task's equal sets are told once."""
    known = rows.sparkSession.sparkContext.broadcast(sketch)

    def index(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[bytes, list] = {}
        for pdf in batches:
            for i, t in zip(pdf["id"], pdf["text"]):
                s = shingles(t, width)
                if not len(s):
                    continue
                sign = xxhash.xxh3_128_digest(s.tobytes())
                if sign in seen:
                    seen[sign][0] = min(seen[sign][0], i)
                else:
                    seen[sign] = [i, *prefix(s, known.value, noise, percent)]
        keys = list(seen)
        for k in range(0, len(keys), 2000):
            part = [(sign, *seen[sign]) for sign in keys[k : k + 2000]]
            size = [len(p[2]) for p in part]
            yield frame({
                "token": np.concatenate([p[2] for p in part]).view(np.int64),
                "sign": np.repeat(np.array([p[0] for p in part], object), size),
                "id": np.repeat(np.array([p[1] for p in part], np.int64), size),
                "share": np.repeat(np.array([p[3] for p in part], np.int32), size),
                "place": np.concatenate([np.arange(n, dtype=np.int32) for n in size]),
            })

    return rows.where("id IS NOT NULL").mapInPandas(index, "token long, sign binary, id long, share int, place int")


def _classed(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Each row with the class of its set so far as ``root``."""
    return sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _sized(percent: int, a: str, b: str) -> Column:
    """What sizes alone allow."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def _similar(percent: int, a: str, b: str) -> Column:
    """What sizes and parity sketches allow: never false for a pair that is similar enough."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    differ = sum((F.bit_count(F.col(f"{a}.b{k}").bitwiseXOR(F.col(f"{b}.b{k}"))) for k in range(1, BITS)), F.bit_count(F.col(f"{a}.b0").bitwiseXOR(F.col(f"{b}.b0"))))
    return _sized(percent, a, b) & (differ * (100 + percent) <= (na + nb) * (100 - percent))


def _allowed(pairs: DataFrame, info: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` that sizes and both parity sketches allow."""
    near = pairs.select(F.col("a").alias("x"), F.col("b").alias("y")).join(info.alias("a"), F.col("x") == F.col("a.node")).join(info.alias("b"), F.col("y") == F.col("b.node"))
    near = near.where(_similar(percent, "a", "b")).select("x", "y", (F.col("a.n") + F.col("b.n")).alias("both"))
    near = near.join(wide.select(F.col("id").alias("x"), F.col("wide").alias("one")), "x", "left").join(wide.select(F.col("id").alias("y"), F.col("wide").alias("two")), "y", "left")
    differ = F.aggregate(F.zip_with("one", "two", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, d: n + d)
    fits = differ * (100 + percent) <= F.col("both") * (100 - percent)
    return near.where(F.col("one").isNull() | F.col("two").isNull() | fits).select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def _verified(pairs: DataFrame, rows: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` whose sets, read again from the texts, are similar enough."""
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    size = FILTER_BITS[0]
    wanted = 16 * nodes.count()
    while size < min(wanted, FILTER_BITS[1]):
        size *= 2

    def places(ids: pd.Series) -> np.ndarray:
        return mix(ids.to_numpy(np.int64).view(np.uint64)) % np.uint64(size)

    def mark(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(size, bool)
        for pdf in batches:
            bits[places(pdf["id"])] = True
        for k, part in enumerate(np.split(np.packbits(bits), BLOCKS)):
            yield frame({"block": [k], "data": [part.tobytes()]})

    marks = rows.sparkSession.sparkContext.broadcast(summed_blocks(nodes.mapInPandas(mark, "block int, data binary"), size // 8, "uint8", np.bitwise_or))

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at = places(pdf["id"])
            own = pdf[marks.value[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1 == 1]
            yield frame({"id": own["id"], "set": [shingles(t, width).tobytes() for t in own["text"]]})

    sets = stage(rows.where("id IS NOT NULL").mapInPandas(read, "id long, set binary"), "own")

    @F.pandas_udf("boolean")
    def close(one: pd.Series, two: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(one, two):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("one")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("set").alias("two")), "b")
    found = stage(both.where(close("one", "two")).select("a", "b").distinct(), "links")
    forget(sets)
    return found


def jaccard_classes(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` of every row.

    Two rows link when ``100 * intersection >= percent * union`` of their sets of
    ``width``-word shingles (A-Z lower-cased, words between ASCII white space; fewer
    words are one shingle).  ``component_id`` is the smallest id that links reach.
    Null and empty texts have no shingles and link with nothing, as do rows without
    an id, whose component is null.  Repeated rows share a component; different texts
    under one id link each for itself; an empty table gives an empty result; other
    columns are ignored.
    """
    rows = texts(docs, id_col, text_col)
    read = _read(rows, width, percent)
    sets = read.where("block < 0")
    if sets.where("n > 0 AND id IS NOT NULL").groupBy("id").agg(F.min("sign").alias("x"), F.max("sign").alias("y")).where("x < y").isEmpty():
        return _classes(rows, read, width, percent)
    # Several sets under one id: rows are numbered in the order of ids, and the numbers stand for the ids.
    rows = numbered(rows, "row", "id")
    names = rows.select("row", F.col("id").alias("name"))
    own = rows.select(F.when(F.col("id").isNotNull(), F.col("row")).alias("id"), "text")
    out = _classes(own, _read(own, width, percent), width, percent)
    named = (
        out.where("id IS NOT NULL").join(names, F.col("id") == F.col("row")).select(F.col("name").alias("doc"), "n_shingles", "component_id")
        .join(names, F.col("component_id") == F.col("row")).select(F.col("doc").alias("id"), "n_shingles", F.col("name").alias("component_id"))
    )
    return named.union(out.where("id IS NULL"))


def _classes(rows: DataFrame, read: DataFrame, width: int, percent: int) -> DataFrame:
    """The classes of rows no two of which have one id and different sets."""
    sets = read.where("block < 0")
    sketch = summed_blocks(read.where("block >= 0").select("block", "data"), COUNTERS, "int32")
    bits = [f"b{k}" for k in range(BITS)]
    nodes = stage(
        sets.where("n > 0 AND id IS NOT NULL").groupBy("sign").agg(F.min("id").alias("node"), F.min("n").alias("n"), *[F.min(b).alias(b) for b in bits]), "nodes"
    )
    indexed = _indexed(rows, sketch, float(sketch.mean()), width, percent)
    index = stage(
        indexed.groupBy("token", "sign").agg(F.min("id").alias("node"), F.min("share").alias("share"), F.min("place").alias("place")).drop("sign"), "index"
    )
    often = index.groupBy("token").agg(F.count("*").alias("times")).where("times > 1").select("token")
    info = nodes.drop("sign").groupBy("node").agg(F.min("n").alias("n"), *[F.min(b).alias(b) for b in bits])
    shared = stage(index.join(often, "token").join(info, "node"), "shared")
    forget(index)

    wide = sets.where("wide IS NOT NULL AND id IS NOT NULL").select("id", "wide")

    # Each set against two sets under its token that hashing picks: first the same sets under all tokens, so that groups of
    # near copies come together with few links each, then, while classes meet, others under each token.
    # Only sizes and classes move with the tokens; the sketches meet the pairs.
    roots = nodes.select("node", F.col("node").alias("root")).limit(0)
    links = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    for turn in range(TURNS):
        across = _classed(shared.select("token", "node", "n"), roots)
        order = F.xxhash64("node", F.lit(turn)) if turn == 0 else F.xxhash64("node", "token", F.lit(turn))
        one = F.struct(order.alias("order"), "root", "n", "node")
        some = across.groupBy("token").agg(F.array_distinct(F.array(F.min(one), F.max(one))).alias("p")).select("token", F.inline("p"))
        stars = across.alias("a").join(some.alias("b"), F.col("a.token") == F.col("b.token"))
        stars = stars.where((F.col("a.root") != F.col("b.root")) & _sized(percent, "a", "b"))
        stars = stars.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()
        stars = stage(_allowed(stars, info, wide, percent), "stars")
        more = _verified(stars, rows, width, percent)
        forget(stars)
        if more.isEmpty():
            break
        links = links.union(more)
        roots = stage(components(links), "roots")

    # All other pairs of a token, between the classes so far.
    across = _classed(shared, roots)
    a, b = across.alias("a"), across.alias("b")
    share = F.least("a.share", "b.share")
    # two sets that are similar enough share so many; without them and the last ``share``, each has this prefix
    overlap = F.ceil((F.col("a.n") + F.col("b.n")) * percent / F.lit(100 + percent))
    within = lambda x: F.col(f"{x}.place") < F.col(f"{x}.n") - overlap + share
    pairs = (
        a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.root") < F.col("b.root")) & _sized(percent, "a", "b") & within("a") & within("b") & _similar(percent, "a", "b"))
        .groupBy(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
        .agg(F.count("*").alias("hits"), F.min(share).alias("share"))
        .where("hits >= share").select("a", "b")
    )
    pairs = stage(_allowed(pairs, info, wide, percent), "pairs")
    forget(shared)
    if not pairs.isEmpty():
        more = _verified(pairs, rows, width, percent)
        if not more.isEmpty():
            roots = stage(components(links.union(more)), "roots")
        forget(pairs)

    classes = nodes.select("sign", "node").join(roots, "node", "left").select("sign", F.coalesce("root", "node").alias("root"))
    full = sets.where("n > 0 AND id IS NOT NULL").select("id", "n", "sign").join(classes, "sign").select("id", "n", "root")
    alone = sets.where("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("root"))
    return full.union(alone).select("id", F.col("n").alias("n_shingles"), F.col("root").alias("component_id"))
