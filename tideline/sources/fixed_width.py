"""Fixed-width records: line-based text and dBASE-style binary tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.dates import DATETIME_TEXT
from tideline.functions.names import col
from tideline.functions.text import strip, whole_number_text
from tideline.sources.union import LINEAGE, source_path, union_by_name

# Characters a logical field may hold.
LOGICAL_TRUE, LOGICAL_FALSE = ("T", "t", "Y", "y"), ("F", "f", "N", "n")


@dataclass(frozen=True)
class Field:
    """One field of a record: name, type letter (C N F L D), width, decimals."""

    name: str
    kind: str
    length: int
    decimals: int = 0


def fields_from_spec(spec: DataFrame) -> list[Field]:
    """Fields from a field-spec frame (one row per column)."""
    rows = spec.orderBy("position").collect()
    return [Field(r["field_name"], r["field_type"], r["length"], r["decimals"]) for r in rows]


def single_byte(encoding: str) -> bool:
    """Does every byte stand for one character?"""
    try:
        return len(bytes(range(256)).decode(encoding, "replace")) == 256
    except LookupError:
        return False


def field_value(text: Column, field: Field, keep_leading_zeros: bool = True, renumber: Sequence[str] = ()) -> Column:
    """Value of one stripped field as text: empty as NULL, numbers undressed, dates ISO.

    Character fields stay as they are (``1.0`` and ``12E3`` may be codes) unless they
    are named in ``renumber``, or zeros in front are to go.
    """
    if field.kind == "D":
        day = F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyyMMdd"))
        return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.nullif(text, F.lit("")))
    if field.kind == "L":
        return F.when(text.isin(*LOGICAL_TRUE), F.lit("True")).when(text.isin(*LOGICAL_FALSE), F.lit("False"))
    if field.kind == "C" and keep_leading_zeros and field.name not in renumber:
        return F.nullif(text, F.lit(""))
    return whole_number_text(text, keep_leading_zeros and field.kind == "C")


def cut_records(
    records: DataFrame, record: Column, fields: Sequence[Field], start: int, keep_leading_zeros: bool,
    encoding: str | None = None, keep: Sequence[Column] = (), renumber: Sequence[str] = (),
) -> DataFrame:
    """Records (text, or bytes of an ``encoding``) cut into one column per field.

    Cutting, stripping and reading are separate steps, so each is done once per
    value however often the next one looks at it.
    """
    raw = []
    if encoding is not None and single_byte(encoding):
        records = records.select(F.decode(record, encoding).alias("__line"), *keep)
        record, encoding, keep = F.col("__line"), None, [F.col(n) for n in records.columns[1:]]
    for f in fields:
        part = F.substring(record, start, f.length)
        # In a multi-byte codepage fields are cut as bytes and decoded one by one.
        raw.append((part if encoding is None else F.decode(part, encoding)).alias(f.name))
        start += f.length
    cut = records.select(*raw, *keep)
    kept = [col(n) for n in cut.columns[len(fields) :]]
    cut = cut.select(*[strip(col(f.name)).alias(f.name) for f in fields], *kept)
    return cut.select(*[field_value(col(f.name), f, keep_leading_zeros, renumber).alias(f.name) for f in fields], *kept)


def read_fixed_text(
    spark: SparkSession,
    path: str | Sequence[str],
    fields: Sequence[Field],
    keep_leading_zeros: bool = True,
    lineage: bool = False,
    encoding: str | None = None,
    renumber: Sequence[str] = (),
) -> DataFrame:
    """Text files with one record per line; splits like any text file.

    Widths are characters of UTF-8, or bytes of the ``encoding``.
    """
    lines = spark.read.text(path if isinstance(path, str) else list(path))
    kept = [source_path(F.col("_metadata.file_path")).alias(LINEAGE)] if lineage else []
    record = F.col("value") if encoding is None else F.col("value").cast("binary")
    return cut_records(lines, record, fields, 1, keep_leading_zeros, encoding, kept, renumber)


def read_dbf(
    spark: SparkSession,
    path: str | Sequence[str],
    encoding: str = "windows-1252",
    deleted: str = "skip",
    keep_leading_zeros: bool = True,
    records_per_task: int = 500_000,
    lineage: bool = False,
    renumber: Sequence[str] = (),
) -> DataFrame:
    """dBASE tables (files, or folders of files), all text.

    Files are cut into record ranges, so one large file is read by many tasks.
    Tasks only slice bytes; decoding and cleaning are Spark expressions.  One
    explicit ``encoding`` per call; ``deleted`` is ``skip`` or ``keep`` (the latter
    adds ``_deleted``).  Files whose fields differ are joined by field name, one
    scan per distinct layout.
    """
    from tideline.sources.dbf_format import list_tables, read_header, register

    if deleted not in ("skip", "keep"):
        raise ValueError("deleted must be 'skip' or 'keep'")
    register(spark)
    layouts: dict[tuple[Field, ...], list[str]] = {}
    for name in [path] if isinstance(path, str) else path:
        for file in list_tables(name):
            layouts.setdefault(read_header(file).fields, []).append(file)
    if not layouts:
        raise FileNotFoundError(f"no dBASE table in {path}")
    frames = []
    for fields, files in layouts.items():
        records = spark.read.format("dbf_records").option("recordsPerTask", records_per_task).load("\n".join(files))
        flagged = F.substring(F.col("record"), 1, 1) == F.lit(bytearray(b"*"))
        if deleted == "skip":
            records = records.filter(~flagged)
        kept = [flagged.alias("_deleted")] if deleted == "keep" else []
        kept += [F.col("file").alias(LINEAGE)] if lineage else []
        frames.append(cut_records(records, F.col("record"), fields, 2, keep_leading_zeros, encoding, kept, renumber))
    return union_by_name(frames)


def legacy_text(c: Column, data_type: T.DataType, keep_leading_zeros: bool = True, renumber: bool = False) -> Column:
    """Text of an already typed legacy value: ISO dates, 12-hour datetimes, bare numbers.

    Text keeps its spelling, codes like ``1.0`` and ``12E3`` included, unless it is to
    be renumbered or to lose its leading zeros.
    """
    if isinstance(data_type, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, DATETIME_TEXT)
    if isinstance(data_type, T.StringType) and keep_leading_zeros and not renumber:
        return F.nullif(strip(c), F.lit(""))
    return whole_number_text(strip(c.cast("string")), keep_leading_zeros)


def legacy_table(df: DataFrame, keep_leading_zeros: bool = True, renumber: Sequence[str] = ()) -> DataFrame:
    """Every column in its legacy text form; text columns are renumbered where they are named."""
    return df.select(
        *[legacy_text(col(f.name), f.dataType, keep_leading_zeros, f.name in renumber).alias(f.name) for f in df.schema.fields]
    )

