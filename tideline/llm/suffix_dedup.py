"""Removal of repeated byte strings by a distributed, sparse suffix array.

Each string of ``LENGTH`` bytes owns an anchor: the least hashed ``GRAM``-byte piece
in it.  Equal strings own equal anchors at equal places, so only suffixes that start at
anchors are sorted, about one in 35.  Anchors that occur once are dropped first.  The
other ones carry what surrounds them: sampled splitters range-partition them by their
leading bytes, and each bucket is sorted locally by multikey quicksort, eight bytes a
step, to the right and to the left of the anchor.  Common prefixes of sorted
neighbours then tell which strings around an anchor occurred earlier.  An anchor that
fills whole buckets lies across their boundaries: its strings are compared one by one, dealt by content.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import frame, mix, stage, texts

LENGTH = 100  # bytes of a string whose repeats go
GRAM = 32  # bytes of an anchor
SIDE = LENGTH - GRAM  # bytes around an anchor that its strings can reach, on either side
AROUND = SIDE + GRAM + SIDE
CHUNK = 1 << 20  # bytes hashed at once
HELD = 1 << 20  # anchors that a task holds before it tells them
HELD_CONTEXTS = 1 << 17
BUCKET = 50_000  # contexts of a bucket, on average
WIDE = 4  # buckets that one anchor must fill to be dealt by its strings
SAMPLES = 40  # sampled contexts for each bucket

_RNG = np.random.default_rng(20240817)
_BYTE = _RNG.integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 2**64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(base)
        np.multiply.accumulate(out, out=out)
    return out


_UP, _DOWN = _powers(_BASE, CHUNK + 2 * LENGTH + 1), _powers(_BACK, CHUNK + 2 * LENGTH + 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every ``GRAM`` bytes (of at most a chunk)."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _UP[: len(data)], out=sums[1:])
    return mix((sums[GRAM:] - sums[:-GRAM]) * _DOWN[: len(data) - GRAM + 1])


def _sliding(x: np.ndarray, size: int, best: np.ufunc) -> np.ndarray:
    done = 1
    while 2 * done <= size:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[: len(x) - (size - done)], x[size - done :]) if done < size else x


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors in texts that lie one after the other, each ending at ``ends``."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = gram_hashes(data)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    least = _sliding(short, SIDE + 1, np.minimum).copy()  # of the string that starts here
    for e in ends[:-1]:  # strings that would cross from one text into the next
        least[max(0, e - LENGTH + 1) : e] = 0
    padded = np.concatenate([np.zeros(SIDE, np.uint32), least, np.zeros(SIDE, np.uint32)])
    most = _sliding(padded, SIDE + 1, np.maximum)  # over the strings that hold this piece
    at = np.flatnonzero((most == short) & (most > 0))
    return at, hashes[at]


def _spans(lengths: np.ndarray) -> Iterator[tuple[list[int], list[tuple[int, int]]]]:
    """Texts dealt to chunks: whole short ones together, long ones in overlapping parts."""
    group: list[int] = []
    size = 0
    for i, n in enumerate(lengths):
        if n > CHUNK:
            for start in range(0, n - LENGTH + 1, CHUNK):
                yield [i], [(start, min(n, start + CHUNK + 2 * LENGTH))]
            continue
        if size + n > CHUNK:
            yield group, [(0, lengths[j]) for j in group]
            group, size = [], 0
        group.append(i)
        size += n
    if group:
        yield group, [(0, lengths[j]) for j in group]


def _anchor_rows(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``h, id, pos, state``: of equal anchors of a task one stands for all (1: it has equals here); the others are known to repeat (2)."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    count = 0

    def told() -> pd.DataFrame:
        h, ids, pos = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.argsort(h, kind="stable")
        h, ids, pos = h[order], ids[order], pos[order]
        new = np.concatenate([[True], h[1:] != h[:-1]])
        again = np.concatenate([~new[1:], [False]])
        return frame({"h": h.view(np.int64), "id": ids, "pos": pos, "state": np.where(new, again.astype(np.int32), np.int32(2))})

    for pdf in batches:
        raw = [t.encode() for t in pdf["text"]]
        ids = pdf["id"].to_numpy(np.int64)
        lengths = np.array([len(r) for r in raw], np.int64)
        for group, spans in _spans(lengths):
            data = np.frombuffer(b"".join(raw[i][a:b] for i, (a, b) in zip(group, spans)), np.uint8)
            ends = np.cumsum([b - a for a, b in spans])
            at, h = anchors(data, ends)
            own = np.searchsorted(ends, at, "right")
            starts = ends - [b - a for a, b in spans]
            held.append((h, ids[np.array(group)[own]], (at - starts[own] + np.array([a for a, _ in spans])[own]).astype(np.int32)))
            count += len(at)
        if count > HELD:
            yield told()
            count = 0
    if count:
        yield told()


def _repeated(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The anchors, of rows sorted by ``h``, that do not occur once."""
    last = None  # the row whose successor is not known yet
    for pdf in batches:
        if not len(pdf):
            continue
        known = pdf["state"].to_numpy() == 2
        yield pdf.loc[known, ["id", "pos"]]
        rest = pdf[~known]
        if last is not None:
            rest = pd.concat([last, rest])
        if not len(rest):
            continue
        h = rest["h"].to_numpy()
        same = np.concatenate([h[1:] == h[:-1], [False]])
        more = (rest["state"].to_numpy() == 1) | same | np.concatenate([[False], same[:-1]])
        yield rest.loc[more[:-1].tolist() + [False], ["id", "pos"]]
        last = rest.iloc[-1:].assign(state=np.int32(more[-1]))
    if last is not None and last["state"].iloc[0] == 1:
        yield last[["id", "pos"]]


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of byte rows: three-way by eight bytes a step, only what is still equal going on."""
    width = -(-rows.shape[1] // 8)
    padded = np.zeros((len(rows), 8 * width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    keys = padded.view(">u8").astype(np.uint64)
    order = np.argsort(keys[:, 0], kind="stable")
    rank = np.cumsum(np.concatenate([[0], keys[order, 0][1:] != keys[order, 0][:-1]])) if len(rows) else np.zeros(0, np.int64)
    for k in range(1, width):
        tied = np.concatenate([rank[1:] == rank[:-1], [False]])
        tied |= np.concatenate([[False], tied[:-1]])
        at = np.flatnonzero(tied)
        if not len(at):
            break
        some, group = order[at], rank[at]
        sub = np.lexsort((keys[some, k], group))
        order[at] = some[sub]
        step = keys[order, k]
        split = np.concatenate([[False], (rank[1:] == rank[:-1]) & (step[1:] != step[:-1]) & tied[1:]])
        rank = np.cumsum(np.concatenate([[0], (rank[1:] != rank[:-1]) | split[1:]]))
    return order


def _common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many leading bytes each sorted row shares with the one before."""
    out = np.zeros(len(order), np.int64)
    step = 50_000
    for k in range(1, len(order), step):
        a, b = rows[order[k - 1 : k - 1 + step]], rows[order[k : k + step]]
        differ = a[: len(b)] != b
        out[k : k + len(b)] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def earlier_strings(around: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last reach to the left (-1: none) of the strings that an earlier row has too.

    Rows are in text order; ``left`` and ``right`` are the bytes that the text has on
    either side of the anchor.
    """
    n = len(around)
    low, high = np.full(n, -1), np.full(n, -1)
    if n < 2:
        return low, high
    after = np.ascontiguousarray(around[:, SIDE:])
    before = np.concatenate([around[:, SIDE : SIDE + GRAM], around[:, :SIDE][:, ::-1]], 1)
    shared = []
    for rows in (after, before):
        order = multikey_order(rows)
        shared.append((order, _common(rows, order)))
    del after, before, rows

    def classes(side: int, reach: int) -> np.ndarray:
        """Numbers of the rows' strings of the anchor and ``reach`` bytes beside it."""
        order, common = shared[side]
        ids = np.empty(n, np.int64)
        ids[order] = np.cumsum(common < GRAM + reach)
        return ids

    for reach in range(SIDE + 1):
        ok = np.flatnonzero((left >= reach) & (right >= SIDE - reach))
        key = classes(1, reach)[ok] * (n + 1) + classes(0, SIDE - reach)[ok]
        order = np.argsort(key, kind="stable")
        again = ok[order[1:][key[order[1:]] == key[order[:-1]]]]
        low[again[low[again] < 0]] = reach
        high[again] = reach
    return low, high


def merged(ids: np.ndarray, th: np.ndarray, first: np.ndarray, stop: np.ndarray) -> dict[str, np.ndarray]:
    """The same bytes in as few intervals of each text as there are gaps."""
    order = np.lexsort((first, th, ids))
    ids, th, first, stop = (x[order].astype(np.int64) for x in (ids, th, first, stop))
    other = np.concatenate([[True], (ids[1:] != ids[:-1]) | (th[1:] != th[:-1])])[: len(ids)]
    text = np.cumsum(other) << 33
    reach = np.maximum.accumulate(stop + text) - text
    new = np.flatnonzero(other | np.concatenate([[True], first[1:] > reach[:-1]])[: len(ids)])
    return {"id": ids[new], "th": th[new], "first": first[new].astype(np.int32), "stop": reach[np.append(new[1:], len(ids))[: len(new)] - 1].astype(np.int32)}


_INTERVAL = "id long, th long, first int, stop int"
_CONTEXT = "around binary, pos int, lft int, rgt int"


def _contexts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What surrounds repeated anchors.  Of equal surroundings in a task the earliest stands for all; the others' strings are all repeats, told as intervals."""
    held: list[tuple] = []
    count = 0

    def told() -> pd.DataFrame:
        around, ids, th, pos, lft, rgt = (np.concatenate(x) for x in zip(*held))
        held.clear()
        order = np.lexsort((pos, th, ids))
        around, ids, th, pos, lft, rgt = (x[order] for x in (around, ids, th, pos, lft, rgt))
        whole = np.ascontiguousarray(np.column_stack([around, lft.astype(np.uint8), rgt.astype(np.uint8)]))
        _, first, which = np.unique(whole.view(f"V{whole.shape[1]}").ravel(), return_index=True, return_inverse=True)
        # the same place of the same text is no repeat of itself
        f = first[which.ravel()]
        same = (ids == ids[f]) & (th == th[f]) & (pos == pos[f])
        new = f == np.arange(len(f))
        rep = ~same & (np.minimum(lft, SIDE) >= SIDE - np.minimum(rgt, SIDE))
        return pd.concat([
            frame({**merged(ids[rep], th[rep], pos[rep] - lft[rep], pos[rep] + GRAM + rgt[rep]), "around": None, "pos": 0, "lft": 0, "rgt": 0}),
            frame({"id": ids[new], "th": th[new], "first": 0, "stop": 0, "around": [x.tobytes() for x in around[new]], "pos": pos[new], "lft": lft[new], "rgt": rgt[new]}),
        ])

    for pdf in batches:
        for i, th, text, places in zip(pdf["id"], pdf["th"], pdf["text"], pdf["places"]):
            data = np.frombuffer(text.encode(), np.uint8)
            at = np.unique(np.asarray(places, np.int64))
            at = at[at + GRAM <= len(data)]
            if not len(at) or len(data) < LENGTH:
                continue
            padded = np.concatenate([np.zeros(SIDE, np.uint8), data, np.zeros(SIDE, np.uint8)])
            around = np.lib.stride_tricks.sliding_window_view(padded, AROUND)[at]
            n = len(at)
            held.append((around, np.full(n, i), np.full(n, th), at, np.minimum(at, SIDE), np.minimum(len(data) - at - GRAM, SIDE)))
            count += n
        if count > HELD_CONTEXTS:
            yield told()
            count = 0
    if count:
        yield told()


def _bucket_intervals(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The repeats among the contexts of each bucket of a partition, whose rows come bucket by bucket; an anchor's contexts are in one bucket."""
    held: list[tuple] = []

    def told() -> pd.DataFrame:
        ids, th, pos, lft, rgt = (np.concatenate([part[k] for part in held]) for k in range(5))
        around = np.concatenate([part[5] for part in held])
        held.clear()
        order = np.lexsort((pos, th, ids))
        # A row that is repeated with its id is one text.
        a, b = order[:-1], order[1:]
        order = order[np.concatenate([[True], (ids[a] != ids[b]) | (th[a] != th[b]) | (pos[a] != pos[b])])]
        ids, th, pos, lft, rgt, around = (x[order] for x in (ids, th, pos, lft, rgt, around))
        low, high = earlier_strings(around, lft, rgt)
        at = np.flatnonzero(low >= 0)
        return frame(merged(ids[at], th[at], pos[at] - high[at], pos[at] - low[at] + LENGTH))

    open_bucket = None
    for pdf in batches:
        buckets = pdf["bucket"].to_numpy()
        for rows in np.split(np.arange(len(pdf)), np.flatnonzero(buckets[1:] != buckets[:-1]) + 1):
            if not len(rows):
                continue
            if held and buckets[rows[0]] != open_bucket:
                yield told()
            open_bucket = buckets[rows[0]]
            some = pdf.iloc[rows]
            around = np.frombuffer(b"".join(some["around"]), np.uint8).reshape(-1, AROUND)
            held.append((*(some[c].to_numpy() for c in ("id", "th", "pos", "lft", "rgt")), around))
    if held:
        yield told()


def _strings(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every string around the anchors: ``string, id, th, first``."""
    for pdf in batches:
        out = []
        for r in pdf.itertuples():
            out += [(r.around[SIDE - k : SIDE - k + LENGTH], r.id, r.th, r.pos - k) for k in range(max(0, SIDE - r.rgt), min(SIDE, r.lft) + 1)]
        yield pd.DataFrame(out, columns=["string", "id", "th", "first"])


def repeated_spans(rows: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``id, th, first, stop`` of byte spans of ``rows (id, th, text)`` that strings of ``LENGTH`` bytes cover which start earlier too."""
    spark = rows.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    found = rows.where(F.octet_length("text") >= LENGTH).select("id", "text").mapInPandas(_anchor_rows, "h long, id long, pos int, state int")
    dealt = found.withColumn("deal", F.when(F.col("state") == 2, F.xxhash64("id", "pos")).otherwise(F.col("h")))
    repeated = dealt.repartition(parts, "deal").sortWithinPartitions("h").drop("deal").mapInPandas(_repeated, "id long, pos int")
    places = stage(repeated.groupBy("id").agg(F.collect_list("pos").alias("places")), "anchors")
    near = rows.join(places, "id").mapInPandas(_contexts, f"{_INTERVAL}, {_CONTEXT}")
    near = stage(near, "contexts")
    intervals = near.where("around IS NULL").select("id", "th", "first", "stop")
    contexts = near.where("around IS NOT NULL").select("id", "th", "around", "pos", "lft", "rgt")

    total = contexts.count()
    buckets = 1 + total // bucket
    key = F.substring("around", SIDE + 1, AROUND - SIDE)
    # Splitters are quantiles of a sample that hashing picks: about SAMPLES for each bucket.
    every = max(1, total // (SAMPLES * buckets))
    sample = contexts.where(F.pmod(F.xxhash64("id", "pos"), F.lit(every)) == 0).select(key.alias("k")).collect() if buckets > 1 else []
    sample = sorted(bytes(r["k"]) for r in sample)
    splitters = [sample[len(sample) * i // buckets] for i in range(1, buckets)] if len(sample) >= buckets else []
    grams = [s[:GRAM] for s in splitters]
    wide = sorted({g for i, g in enumerate(grams) if grams[i : i + WIDE] == [g] * WIDE})

    @F.pandas_udf("int")
    def bucket_of(gram: pd.Series) -> pd.Series:
        return pd.Series([-1 if wide and (k := bisect_left(wide, g)) < len(wide) and wide[k] == g else bisect_right(grams, g) for g in map(bytes, gram)], dtype="int32")

    placed = contexts.withColumn("bucket", bucket_of(F.substring("around", SIDE + 1, GRAM)))
    narrow = placed.where("bucket >= 0").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    out = intervals.union(narrow.mapInPandas(_bucket_intervals, _INTERVAL))
    if wide:
        strings = stage(placed.where("bucket < 0").mapInPandas(_strings, "string binary, id long, th long, first int"), "strings")
        start = strings.groupBy("string").agg(F.min(F.struct("id", "th", "first")).alias("least"), F.count("*").alias("n")).where("n > 1")
        later = strings.join(start, "string").where(F.struct("id", "th", "first") != F.col("least"))
        out = out.union(later.select("id", "th", "first", (F.col("first") + LENGTH).alias("stop")))
    return out


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept, kept_sha256`` of every row.

    A byte of a text (UTF-8; null: empty) goes if a string of ``LENGTH`` bytes covers
    it that also starts earlier: in a text of smaller id, or earlier in the same
    text; strings are judged on the input.  ``kept`` is what is left, null where
    that is the whole text.  Rows of the same id and text are one text and do not
    repeat each other; other texts under one id are ordered by a hash.  Rows
    without an id stay whole and make no repeats.  An empty table gives an empty
    result; other columns are ignored.
    """
    rows = texts(docs, id_col, text_col).withColumn("th", F.xxhash64("text"))
    spans = repeated_spans(rows.where("id IS NOT NULL"), bucket)
    spans = spans.groupBy("id", "th").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))

    @F.pandas_udf("removed long, spans long, kept binary")
    def cut(text: pd.Series, firsts: pd.Series, stops: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(text, firsts, stops):
            if t is None or a is None:
                out.append((0, 0, None))
                continue
            raw = t.encode()
            gone = np.zeros(len(raw) + 2, np.int32)
            np.add.at(gone, np.asarray(a) + 1, 1)
            np.add.at(gone, np.asarray(b) + 1, -1)
            gone = gone.cumsum() > 0
            mask = gone[1:-1]
            out.append((int(mask.sum()), int((gone[1:] & ~gone[:-1]).sum()), np.frombuffer(raw, np.uint8)[~mask].tobytes()))
        return pd.DataFrame(out, columns=["removed", "spans", "kept"]).astype({"removed": "int64", "spans": "int64"})

    both = rows.join(spans, ["id", "th"], "left")
    touched = F.col("spans").isNotNull()
    both = both.withColumn("c", cut(F.when(touched, F.col("text")), F.col("spans.first"), F.col("spans.stop")))
    return both.select(
        "id", F.octet_length("text").cast("long").alias("n_bytes"), F.col("c.removed").alias("n_removed"), F.col("c.spans").alias("n_spans"), F.col("c.kept").alias("kept"),
        F.when(touched, F.sha2("c.kept", 256)).otherwise(F.sha2("text", 256)).alias("kept_sha256"),
    )
