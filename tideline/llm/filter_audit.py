"""What each filter removes, alone and after others, over a sparse document-term matrix.

Tasks count the words of their documents into shards of a compressed-sparse-row matrix
whose columns are the shard's own words.  The words of all shards get global numbers
in hashed ranges, which replace the shard's; a row's sum is then its number of words and
its nonzero entries are its distinct words.  Filters become bits of a mask, and every
order of filters is read from the counts of masks.
"""

from __future__ import annotations

import itertools
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.common import stage

# A shard is one row, which tasks copy between the JVM and Python several times: it stays at about 2 MB.
SHARD_WORDS = 1 << 16  # a shard ends with the document that brings it to so many distinct words,
SHARD_CELLS = 1 << 19  # to so many cells,
SHARD_ROWS = 1 << 13  # or to so many documents
RANGE_BYTES = 8 << 20  # the dictionary is numbered in hashed ranges, one for so many bytes of text
RANGES = (64, 1 << 30)  # least and most of them
CSR = "starts binary, words binary, counts binary"


def _listed(schema: T.StructType, without: str) -> str:
    return ", ".join(f"`{f.name}` array<{f.dataType.simpleString()}>" for f in schema if f.name != without)


def _packed(own: dict[bytes, int], starts: list[int], places: array, counts: array, ranges: int) -> dict[str, object]:
    """A shard with its words in the order of ranges and each row's places ascending, as differences."""
    words = sorted(own)
    which = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) & (ranges - 1)
    order = np.argsort(which, kind="stable")
    place = np.empty(len(words), np.int64)
    place[np.fromiter(map(own.__getitem__, words), np.int64, len(words))[order]] = np.arange(len(words))
    start = np.array(starts, np.int64)
    cells = place[np.frombuffer(places, np.int32)]
    by_place = np.argsort(np.repeat(np.arange(len(start) - 1), np.diff(start)) << 32 | cells)
    cells = np.diff(cells[by_place], prepend=0)
    which = which[order]
    first = np.flatnonzero(np.diff(which, prepend=-1))
    ends = [*first.tolist(), len(words)]
    ordered = [words[k] for k in order.tolist()]
    return {
        "starts": start.tobytes(), "words": cells.astype(np.int32).tobytes(), "counts": np.frombuffer(counts, np.uint32)[by_place].tobytes(),
        "vocabulary": [{"range": int(which[a]), "first": a, "words": b" ".join(ordered[a:b])} for a, b in zip(ends, ends[1:])],
    }


def _shards(docs: DataFrame, text: str, ranges: int) -> DataFrame:
    """Shards whose columns are places in their own ``vocabulary``; other columns of the documents as lists."""
    keep = [c for c in docs.columns if c != text]
    piece = pa.struct([("range", pa.int32()), ("first", pa.int32()), ("words", pa.binary())])

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        made = itertools.count()

        def shard() -> pa.RecordBatch:
            packed = _packed(own, starts, places, counts, ranges)
            columns = {"shard": pa.array([base + next(made)])} | {c: pa.array([packed[c]]) for c in ("starts", "words", "counts")}
            columns |= {"vocabulary": pa.array([packed["vocabulary"]], pa.list_(piece))}
            columns |= {c: pa.array([kept[c]], pa.list_(batch.schema.field(c).type)) for c in keep}
            return pa.RecordBatch.from_pydict(columns)

        own: dict[bytes, int] = {}
        starts, places, counts, kept = [0], array("i"), array("I"), {c: [] for c in keep}
        for batch in batches:
            values = {c: batch.column(c).to_pylist() for c in keep}
            for k, t in enumerate(batch.column(text).to_pylist()):
                found = Counter(t.encode("utf-8", "surrogatepass").split())
                places.extend([own.setdefault(w, len(own)) for w in found])
                counts.extend(found.values())
                starts.append(len(places))
                for c in keep:
                    kept[c].append(values[c][k])
                if len(own) >= SHARD_WORDS or len(places) >= SHARD_CELLS or len(starts) > SHARD_ROWS:
                    yield shard()
                    own = {}
                    starts, places, counts, kept = [0], array("i"), array("I"), {c: [] for c in keep}
        if len(starts) > 1:
            yield shard()

    vocabulary = "vocabulary array<struct<range: int, first: int, words: binary>>"
    return stage(docs.mapInArrow(build, f"shard long, {CSR}, {vocabulary}, {_listed(docs.schema, text)}"), "shards")


def _number(pieces: pa.Table) -> pa.Table:
    """The words of one range, from all shards: each one's rank, as differences, since a shard's are in order."""
    found = [p.split(b" ") for p in pieces["words"].to_pylist()]
    rank = {w: k for k, w in enumerate(sorted(set(itertools.chain.from_iterable(found))))}
    ranks = [np.diff(np.fromiter(map(rank.__getitem__, f), np.int64, len(f)), prepend=0).astype(np.int32).tobytes() for f in found]
    return pieces.drop_columns(["words"]).append_column("ranks", pa.array(ranks, pa.binary()))


def _renumber(own: pa.Table, known: pa.Table) -> pa.Table:
    """A shard with global numbers in place of its places."""
    parts = sorted(zip(*(known[c].to_pylist() for c in ("first", "range", "ranks"))))
    globally = np.concatenate([np.cumsum(np.frombuffer(ranks, np.int32), dtype=np.int64) | which << 32 for _, which, ranks in parts] or [np.zeros(0, np.int64)])
    words = [globally[np.cumsum(np.frombuffer(w, np.int32))].tobytes() for w in own["words"].to_pylist()]
    return own.set_column(own.column_names.index("words"), own.schema.field("words"), [pa.array(words, pa.binary())])


def document_term_matrix(docs: DataFrame, text: str = "text") -> DataFrame:
    """The shards of ``docs``' document-term matrix, with one dictionary for all of them.

    A shard is a row: ``starts`` (64-bit offsets of its documents), ``words`` (64-bit global
    numbers of words), ``counts`` (32-bit, unsigned), and each other column of ``docs`` as a list in
    the same order.  Words are maximal runs without ASCII white space, case kept.  A shard
    ends with the document that fills it, so a very long text is a shard of its own.  ``text``
    must not be null.  An empty table has no shards.

    A word's number is its rank among the words of its range, which a checksum picks; ranges
    are as many as the text is long.  A word occurs once in a shard, so a range holds
    no more than its share of words and one entry of a common word from each shard.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]
    ranges = min(max(RANGES[0], 1 << (size // RANGE_BYTES).bit_length()), RANGES[1])
    shards = _shards(docs, text, ranges)
    pieces = shards.select("shard", F.inline("vocabulary"))
    numbers = pieces.groupBy("range").applyInArrow(_number, "shard long, range int, first int, ranks binary")
    body = shards.drop("vocabulary")
    return body.groupBy("shard").cogroup(numbers.groupBy("shard")).applyInArrow(_renumber, body.schema)


def row_statistics(matrix: DataFrame) -> DataFrame:
    """The documents of the shards again, with ``n_words`` (row sum) and ``n_distinct`` (nonzero entries)."""
    kept = [f for f in matrix.schema if isinstance(f.dataType, T.ArrayType)]
    fields = ", ".join(f"`{f.name}` {f.dataType.elementType.simpleString()}" for f in kept)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                starts = np.frombuffer(batch.column("starts")[k].as_py(), np.int64)
                counts = np.frombuffer(batch.column("counts")[k].as_py(), np.uint32)
                sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[starts]
                cells = np.concatenate([[0], np.cumsum(counts != 0)])[starts]
                columns = {f.name: batch.column(f.name)[k].values for f in kept}
                yield pa.RecordBatch.from_pydict({**columns, "n_words": np.diff(sums), "n_distinct": np.diff(cells)})

    return matrix.mapInArrow(read, f"{fields}, n_words long, n_distinct long")


def repeats(digest: str, doc_id: str, rows: DataFrame) -> DataFrame:
    """``rows`` with ``repeated``: whether a smaller id has the same ``digest`` anywhere in the table.

    A null id is smaller than none and has none below it.  Groups are combined before the
    shuffle, and only digests that occur under several ids are joined.
    """
    first = rows.groupBy(digest).agg(F.min(doc_id).alias("_first"), F.max(doc_id).alias("_last")).where("_first < _last").select(digest, "_first")
    return rows.join(first, digest, "left").withColumn("repeated", F.coalesce(F.col(doc_id) > F.col("_first"), F.lit(False))).drop("_first")


def filter_orders(masks: DataFrame, letters: str) -> DataFrame:
    """Each part's result of all orders of filters.

    ``masks`` has ``part``, ``mask`` (bit i: the i-th letter's filter fails) and the counts
    ``n``, ``good`` and ``toxic``.  Returns ``part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley``.
    """
    bit = {c: 1 << i for i, c in enumerate(letters)}
    steps = [
        ("".join(order), k + 1, sum(bit[c] for c in order[:k]), bit[order[k]])
        for order in itertools.permutations(letters)
        for k in range(len(letters))
    ]
    orders = 1
    for k in range(2, len(letters) + 1):
        orders *= k
    every = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("before"), F.lit(own).alias("own")) for o, s, b, own in steps])
    # masks of a part are few: they become one map, and each order reads it
    by_part = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    rows = by_part.select("part", "masks", F.explode(every).alias("s")).select("part", "masks", "s.*")

    def total(column: str, condition) -> Column:
        picked = F.filter("masks", condition)
        return F.aggregate(picked, F.lit(0).cast("long"), lambda a, m: a + m[column])

    before, own = F.col("before"), F.col("own")
    hits = lambda m: m["mask"].bitwiseAND(own) != 0
    free = lambda m: m["mask"].bitwiseAND(before) == 0
    return rows.select(
        "part", "filter_order", "step",
        total("n", lambda m: m["mask"].bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total("n", lambda m: hits(m) & free(m)).alias("removed"),
        total("n", lambda m: hits(m) & ~free(m)).alias("redundant"),
        total("n", lambda m: m["mask"] == own).alias("unique_fails"),
        total("good", lambda m: hits(m) & free(m)).alias("good_lost"),
        total("toxic", lambda m: hits(m) & free(m)).alias("toxic_lost"),
        # of the filters that a document fails, each comes first in an equal share of all orders
        F.aggregate(F.filter("masks", hits), F.lit(0).cast("long"), lambda a, m: a + (m["n"] * orders / F.bit_count(m["mask"])).cast("long")).alias("shapley"),
    )


#: The filters' failure conditions over ``text``, ``n_words``, ``n_distinct`` and ``repeated``.
TEXT_FILTERS = {
    "C": "100 * (char_length(text) - char_length(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * char_length(text)",
    "D": "text RLIKE '[#$%&*|]'",
}
ROW_FILTERS = {"A": "n_words < 100", "B": "100 * n_distinct < 80 * n_words", "E": "repeated"}


def filter_audit(
    docs: DataFrame, labels: DataFrame, text_filters: Mapping[str, str] = TEXT_FILTERS, row_filters: Mapping[str, str] = ROW_FILTERS,
    id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
) -> DataFrame:
    """How filters work on each other, for each part of the documents and every order of filters.

    ``text_filters`` are conditions over ``text``, ``row_filters`` over ``n_words``, ``n_distinct``
    and ``repeated`` (a smaller id has the identical text); each letter names a condition that a
    document fails by.  A null text counts as empty, a null part as the empty string.  Every row
    counts, repeated ones and those without an id included; rows of one id are not repeats of
    each other, a row without an id repeats nothing.  ``labels (doc_id, quality, toxic)`` count as 1
    if any of a document's labels is 1.  Steps that remove nothing have zeros; an empty table has
    no parts and gives an empty result.  Other columns are ignored.  Texts are told apart by SHA-256.
    """
    letters = "".join(sorted([*text_filters, *row_filters]))
    bit = {c: 1 << i for i, c in enumerate(letters)}

    def mask(conditions: Mapping[str, str]) -> Column:
        flags = [F.when(F.expr(sql), F.lit(bit[c])).otherwise(F.lit(0)) for c, sql in conditions.items()]
        return sum(flags[1:], flags[0]) if flags else F.lit(0)

    rows = docs.select(docs[id_col].cast("long").alias("id"), F.coalesce(docs[part_col].cast("string"), F.lit("")).alias("part"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = rows.select("*", mask(text_filters).alias("flags"), F.unhex(F.sha2("text", 256)).alias("digest"))
    counted = stage(row_statistics(document_term_matrix(rows)), "counted")
    masked = repeats("digest", "id", counted).select("id", "part", (F.col("flags") + mask(row_filters)).alias("mask"))
    one = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("long"))
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    counts = masked.join(known, "id", "left").groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )
    return filter_orders(counts, letters)
