"""Packing documents into sequences by bin completion.

Only the number of pieces of each length decides how many sequences are needed, so
the search runs on that table (at most ``size`` counters, whatever the corpus) and
its plan says which rank of which length goes where.  Ranks are dealt on the executors.
"""

from __future__ import annotations

import itertools
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import frame, stage, texts
from tideline.llm.tokens import Ids, encoder

RANK_GROUP = 200_000  # pieces that one task ranks, on average
NODES = 3_000  # fillings that the search may try before the best plan so far is taken

Plan = list[tuple[int, tuple[int, ...]]]  # (how many sequences, the lengths in each)


def lower_bound(counts: dict[int, int], size: int) -> int:
    """Martello and Toth's second bound: what no packing can beat."""
    n = np.zeros(size + 1, object)
    for length, k in counts.items():
        n[length] = k
    total = [0, *np.cumsum(n)]
    mass = [0, *np.cumsum(n * np.arange(size + 1))]
    best = -(-mass[-1] // size)
    for k in range(size // 2 + 1):
        alone = total[-1] - total[size - k + 1]
        mid_n, mid_sum = total[size - k + 1] - total[size // 2 + 1], mass[size - k + 1] - mass[size // 2 + 1]
        low = mass[size // 2 + 1] - mass[k]
        best = max(best, alone + mid_n + max(0, -(-(low - (mid_n * size - mid_sum)) // size)))
    return int(best)


def best_fit(counts: dict[int, int], size: int) -> Plan:
    """Best-fit decreasing over whole runs of equal lengths."""
    open_bins: dict[int, Counter] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r, b in open_bins.items() if r >= length and b), default=None)
            if room is None:
                n = -(-left // (size // length))
                open_bins.setdefault(size - length, Counter())[(length,)] += n
                left -= n
                continue
            what, have = next(iter(open_bins[room].items()))
            n = min(left, have)
            open_bins[room][what] -= n
            if not open_bins[room][what]:
                del open_bins[room][what]
            open_bins.setdefault(room - length, Counter())[(*what, length)] += n
            left -= n
    return [(n, what) for b in open_bins.values() for what, n in b.items()]


def _sums(lengths: list[int], room: int) -> list[int]:
    """For each prefix of ascending lengths, the sums it can reach, as bits."""
    full, out, reach = (1 << room + 1) - 1, [1], 1
    for length in lengths:
        step = length
        while step <= room:
            reach |= reach << step & full
            step *= 2
        out.append(reach)
    return out


def fillings(counts: Counter, room: int, most_waste: int) -> Iterator[tuple[int, ...]]:
    """Undominated fillings of ``room``, least waste first, larger lengths first.

    A filling that leaves as much as an unused length is dominated and left out,
    as is one of more waste than the bound allows.
    """
    lengths = sorted(x for x, n in counts.items() if n and x <= room)
    if not lengths:
        if room <= most_waste:
            yield ()
        return
    reach = _sums(lengths, room)

    def walk(target: int, upto: int, used: tuple[int, ...]) -> Iterator[tuple[int, ...]]:
        if not target:
            yield used
            return
        for i in range(upto, 0, -1):
            length = lengths[i - 1]
            if length > target or not reach[i] >> target & 1:
                continue
            if used.count(length) < counts[length] and reach[i] >> target - length & 1:
                yield from walk(target - length, i, (*used, length))

    for waste in range(min(most_waste, room) + 1):
        for found in walk(room - waste, len(lengths), ()):
            if not any(x <= waste and counts[x] > found.count(x) for x in lengths):
                yield found


def plan_sequences(counts: dict[int, int], size: int, nodes: int = NODES) -> Plan:
    """Which lengths share a sequence, in as few sequences as the search finds.

    Branch and bound: the largest length left gets a filling, the one with the
    least waste first; a branch ends when its waste exceeds what an improvement
    on the incumbent allows.  The incumbent is best-fit decreasing; the search
    stops at the lower bound, where it is proven best, or after ``nodes`` fillings.
    """
    counts = {k: n for k, n in counts.items() if n}
    incumbent = best_fit(counts, size)
    best, bound = sum(n for n, _ in incumbent), lower_bound(counts, size) if counts else 0
    mass = sum(k * n for k, n in counts.items())
    left, path, tried, waste = Counter(counts), [], 0, 0
    taken: list[int] = []  # how many fillings of each open branch were tried; they are enumerated anew on the way back
    now: Iterator[tuple[int, ...]] | None = None

    def branch() -> Iterator[tuple[int, ...]]:
        top = path[-1][1][0]
        return itertools.islice(fillings(left - Counter((top,)), size - top, (best - 1) * size - mass - waste), taken[-1], None)

    if best > bound and counts:
        path.append((0, (max(left),)))
        taken.append(0)
    while path and best > bound and tried < nodes:
        times, what = path[-1]
        if times:  # back from a deeper branch
            for x in what:
                left[x] += times
            waste -= times * (size - sum(what))
            path[-1] = (0, what[:1])
        top = what[0]
        filling = next(now or branch(), None)
        now = None
        tried += 1
        if filling is None:
            path.pop()
            taken.pop()
            continue
        taken[-1] += 1
        what = (top, *filling)
        each = Counter(what)
        spare = size - sum(what)
        times = min(left[x] // n for x, n in each.items())
        if spare:
            times = max(1, min(times, ((best - 1) * size - mass - waste) // spare))
        path[-1] = (times, what)
        for x, n in each.items():
            left[x] -= n * times
        waste += times * spare
        left = +left
        if not left:
            total = sum(n for n, _ in path)
            if total < best:
                best, incumbent = total, list(path)
        elif waste <= (best - 1) * size - mass:
            path.append((0, (max(left),)))
            taken.append(0)
            now = branch()
    return incumbent


def slots(plan: Plan) -> pd.DataFrame:
    """``length, rank`` (first of a run), ``sequence`` (of that rank) and ``offset``."""
    rows, seen, base = [], Counter(), 0
    for times, what in plan:
        at = 0
        for length in what:
            rows.append((length, seen[length], base, at))
            seen[length] += times
            at += length
        base += times
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def cut_pieces(docs: DataFrame, path: str, size: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """``id, piece, start, length, ids_crc32`` of every piece; only the first may be short."""

    def cut(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(("ids", path), lambda: Ids(path))
        end = np.array([end_id], "<u4").tobytes()
        for pdf in batches:
            out: list[tuple] = []
            for i, text in zip(pdf["id"], pdf["text"]):
                ids = e.ids(text) + end
                n = len(ids) // 4
                starts = [0, *range(n % size or size, n, size), n]
                out += [(i, k, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for k, (a, b) in enumerate(zip(starts, starts[1:]))]
            yield pd.DataFrame(out, columns=["id", "piece", "start", "length", "ids_crc32"]).astype({"id": "Int64"})

    return texts(docs, id_col, text_col).mapInPandas(cut, "id long, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    A document is its ids by the vocabulary at ``path`` and ``end_id``; null and
    empty texts are just that id.  Longer ones than ``size`` are cut, the first
    piece taking the remainder.  Every piece is placed once and sequences are
    gapless.  Repeated rows are packed one by one, a null id stays null, an empty
    table gives an empty result, other columns are ignored.
    """
    pieces = stage(cut_pieces(docs, path, size, end_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = slots(plan_sequences(counts, size))
    # A rank is its place in a salted group, plus the groups before; no length is ranked by one task alone.
    groups = 1 + sum(counts.values()) // RANK_GROUP
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("id", "piece"), F.lit(groups)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = before.withColumn("base", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece")) - 1
    ranked = salted.withColumn("place", place).join(before, ["length", "salt"]).withColumn("rank", F.col("base") + F.col("place"))
    known = docs.sparkSession.sparkContext.broadcast({k: g[["rank", "sequence", "offset"]].to_numpy(np.int64) for k, g in plan.groupby("length")})

    def put(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rank, seq, off = pdf["rank"].to_numpy(), np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for length, at in pdf.groupby("length").indices.items():
                runs = known.value[length]
                run = runs[np.searchsorted(runs[:, 0], rank[at], "right") - 1]
                seq[at], off[at] = run[:, 1] + rank[at] - run[:, 0], run[:, 2]
            yield pdf[["id", "piece", "start", "length", "ids_crc32"]].astype({"id": "Int64"}).assign(sequence_id=seq, offset=off)

    return ranked.select("id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        put, "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
