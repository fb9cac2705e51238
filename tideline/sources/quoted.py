"""Delimited files whose quoted values hold line breaks, read in byte ranges.

Whether a range starts inside a quoted value depends on all bytes before it.  Each line
says how it takes the state outside to inside and back, a range's lines together do
the same, and these small transitions, one per range, are composed along each file.
With its first state known, a task puts its lines together into records; only
the records that a cut runs through meet in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.sources.records import Dialect
from tideline.sources.union import source_path

FILE, BLOCK, AT = "__file", "__block", "__at"
# Ranges whose first states are sent to every task; more are joined by a shuffle.
BROADCAST_RANGES = 100_000
# A record longer than this is taken for a quote that never closes.
MOST_BYTES = 256 << 20
# Where opening a file costs this much, each is a task of its own.
ALONE = 1 << 50
# Encodings in which a quote, a separator or a line end may be part of another character.
WIDE = ("utf-16", "utf16", "utf-32", "utf32", "ucs-2", "ucs-4")


class UnclosedQuote(ValueError):
    """A quoted value that is longer than any record may be."""


def splittable(options: dict, encoding: str) -> bool:
    """Can files with these options be cut at any line end?"""
    return not encoding.lower().startswith(WIDE) and "lineSep" not in options and "comment" not in options and len(str(options.get("quote", '"'))) <= 1


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The bytes of every line, with its file, where its range starts, and its place in the task."""
    lines = spark.read.option("lineSep", "\n").text(list(paths))
    return lines.select(
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(AT), F.col("value").cast("binary").alias("line"),
    )


def range_states(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """For each range: is its first line inside a quoted value, and is what follows its last one?"""

    def transitions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ends = None, [False, True]

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({FILE: [now[0]], BLOCK: [now[1]], "outside": [ends[0]], "inside": [ends[1]]})

        for batch in batches:
            for file, block, line in zip(*(batch.column(c).to_pylist() for c in (FILE, BLOCK, "line"))):
                if (file, block) != now:
                    if now:
                        yield told()
                    now, ends = (file, block), [False, True]
                if dialect.quote in line:
                    ends = [dialect.open_after(line, e) for e in ends]
        if now:
            yield told()

    found = lines.select(FILE, BLOCK, "line").mapInArrow(transitions, f"{FILE} string, {BLOCK} long, outside boolean, inside boolean")
    # A range either sets the state, whatever it was, or keeps it, or turns it around.
    turns = (F.col("outside") & ~F.col("inside")).cast("int")
    along = Window.partitionBy(FILE).orderBy(BLOCK)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    counted = found.withColumn("turned", F.sum(turns).over(along))
    sets = F.when(F.col("outside") == F.col("inside"), F.struct(F.col("outside").cast("int").alias("state"), F.col("turned").alias("turned")))
    last = F.last(sets, ignorenulls=True).over(before)
    known = counted.withColumn("last", last).withColumn("already", F.coalesce(F.sum(turns).over(before), F.lit(0)))
    start = (F.coalesce(F.col("last.state"), F.lit(0)) + F.col("already") - F.coalesce(F.col("last.turned"), F.lit(0))) % 2 == 1
    return known.select(FILE, BLOCK, start.alias("starts"), F.when(start, F.col("inside")).otherwise(F.col("outside")).alias("ends"))


def _records(lines: DataFrame, dialect: Dialect, whole: bool) -> DataFrame:
    """Records that lie in one range (``whole``), or the parts of records that a cut runs through."""

    def together(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, parts, size = None, False, [], 0
        opened = first = False  # did this record begin in the range; is it the file's first
        made: list[tuple] = []

        def end(complete: bool) -> None:
            if whole == (opened and complete):
                made.append((now[0], now[1], opened, first, b"\n".join(parts)))

        def told() -> pa.RecordBatch:
            columns = list(zip(*made)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [FILE, BLOCK, "opens", "first", "record"])

        for batch in batches:
            for file, block, starts, line in zip(*(batch.column(c).to_pylist() for c in (FILE, BLOCK, "starts", "line"))):
                if (file, block) != now:
                    if parts:
                        end(False)
                    now, inside, parts, size = (file, block), starts, [], 0
                    opened, first = not starts, block == 0
                parts.append(line)
                size += len(line) + 1
                if size > MOST_BYTES:
                    raise UnclosedQuote(f"{file}: a quoted value from byte range {block} on does not end within {MOST_BYTES} bytes")
                inside = dialect.open_after(line, inside)
                if not inside:
                    end(True)
                    # an empty line before the header is no record
                    parts, size, opened, first = [], 0, True, first and not line.strip() and len(parts) == 1
            yield told()
            made.clear()
        if parts:
            end(False)
            yield told()

    return lines.mapInArrow(together, f"{FILE} string, {BLOCK} long, opens boolean, first boolean, record binary")


def read_records(spark: SparkSession, paths: Sequence[str], dialect: Dialect) -> DataFrame:
    """``__file, first, record`` of every record: its bytes, and whether it is its file's first.

    Records keep their inner line ends; the last one is cut off.  A file is read in as many
    tasks as it has ranges (``spark.sql.files.maxPartitionBytes``).
    """
    lines = _lines(spark, paths)
    states = range_states(lines, dialect)
    few = states.count() <= BROADCAST_RANGES
    joined = lines.join(F.broadcast(states) if few else states, [FILE, BLOCK])
    if not few:
        joined = joined.sortWithinPartitions(FILE, BLOCK, AT)
    whole = _records(joined, dialect, True).select(FILE, "first", "record")
    cut = _records(joined.where("starts OR ends"), dialect, False)
    # Parts follow each other along the file; one that begins a record starts a new one.
    along = Window.partitionBy(FILE).orderBy(BLOCK, "opens")
    numbered = cut.withColumn("number", F.sum(F.col("opens").cast("int")).over(along))
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, F.col("opens").alias("later"), "record")))
    line_end = F.lit(b"\n")
    glued = F.aggregate(F.slice("parts", 2, 1 << 30), F.col("parts")[0]["record"], lambda a, p: F.concat(a, line_end, p["record"]))
    stitched = numbered.groupBy(FILE, "number").agg(parts.alias("parts"), F.max("first").alias("first")).select(FILE, "first", glued.alias("record"))
    return whole.unionAll(stitched)


def first_records(spark: SparkSession, paths: Sequence[str], dialect: Dialect) -> dict[str, bytes]:
    """The first record of each file, by its path without ``file:``; empty files have none.

    Files are read by tasks, and each only as far as its first record goes if it is a task's only one.
    """

    def begin(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, inside, done = None, [], False, True
        for batch in batches:
            found = []
            for file, block, line in zip(*(batch.column(c).to_pylist() for c in (FILE, BLOCK, "line"))):
                if (file, block) != now:
                    if not done:
                        found.append((now[0], b"\n".join(parts)))
                    now, parts, inside, done = (file, block), [], False, block != 0
                if done or not (parts or line.strip()):
                    continue
                parts.append(line)
                inside = dialect.open_after(line, inside)
                if not inside:
                    found.append((file, b"\n".join(parts)))
                    done = True
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found]), pa.array([r for _, r in found], pa.binary())], [FILE, "record"])
            if done and alone:
                return
        if not done and parts:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]]), pa.array([b"\n".join(parts)], pa.binary())], [FILE, "record"])

    alone = int(spark.conf.get("spark.sql.files.openCostInBytes").rstrip("b")) >= ALONE
    records = _lines(spark, paths).select(FILE, BLOCK, "line").mapInArrow(begin, f"{FILE} string, record binary")
    rows = records.select(source_path(F.col(FILE)).alias("path"), without_line_end(F.col("record")).alias("record")).collect()
    return {r["path"]: bytes(r["record"]) for r in rows}


def without_line_end(record: Column) -> Column:
    """Without the carriage return that a line end may leave."""
    size = F.octet_length(record)
    ends = F.substring(record, size, F.lit(1)) == F.lit(b"\r")
    return F.when(ends, F.substring(record, F.lit(1), size - 1)).otherwise(record)


def _declared(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def read_quoted(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType, sep: str, header: bool, encoding: str, options: dict, lineage: str | None = None
) -> DataFrame:
    """Parsed records under a schema of text columns, in the columns' order, with their path if asked for."""
    records = read_records(spark, paths, Dialect.of(sep, options, encoding))
    if header:
        records = records.where("NOT first")
    record = without_line_end(F.col("record"))
    text = F.decode(record, encoding) if encoding.lower().replace("-", "") != "utf8" else record.cast("string")
    parsed = records.where(F.octet_length(record) > 0).select(
        *([source_path(F.col(FILE)).alias(lineage)] if lineage else []),
        F.from_csv(text, _declared(schema), {"sep": sep, "escape": '"', "mode": "PERMISSIVE", **{k: str(v) for k, v in options.items()}, "multiLine": "true"}).alias("values"),
    )
    return parsed.select("values.*", *([lineage] if lineage else []))
