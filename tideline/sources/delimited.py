"""Delimited files: every column text, ragged rows tolerated and reported."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.names import col
from tideline.functions.text import NULL_TOKENS, blank_to_null
from tideline.sources.quoted import ALONE, first_records, read_quoted, splittable
from tideline.sources.records import Dialect, header_names
from tideline.sources.union import with_source_file

CORRUPT = "_corrupt_record"
# Options a spec may carry for other readers; everything is text here.
IGNORED_OPTIONS = ("infer_schema_length", "try_parse_dates", "schema_overrides")
# Reader options that change how a header line is read; Spark reads such headers, file by file.
HEADER_OPTIONS = ("comment", "lineSep", "nullValue", "ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace", "charToEscapeQuoteEscaping")
# Files up to this size share tasks when their headers are read.
SMALL_FILE = 1 << 20
HEADER_THREADS = 16


def split_options(options: dict | None) -> dict:
    """Spec options in this module's terms: sep, header, null_tokens, reader."""
    options = {k: v for k, v in (options or {}).items() if k not in IGNORED_OPTIONS}
    return {
        "sep": options.pop("separator", options.pop("sep", ",")),
        "header": options.pop("has_header", options.pop("header", True)),
        "null_tokens": tuple(options.pop("null_values", NULL_TOKENS)),
        "encoding": options.pop("encoding", "UTF-8"),
        "reader": options,
    }


def _reader(spark: SparkSession, sep: str, header: bool, encoding: str, extra: dict):
    return (
        spark.read.option("sep", sep).option("header", header).option("encoding", encoding)
        .option("escape", '"').option("inferSchema", False).option("mode", "PERMISSIVE").options(**extra)
    )


def header_of(spark: SparkSession, path: str, sep: str = ",", header: bool = True, encoding: str = "UTF-8", **extra) -> list[str]:
    """Column names of one file (``column_1`` ... without a header line)."""
    names = _reader(spark, sep, header, encoding, extra).csv(path).columns
    return names if header else [f"column_{i + 1}" for i in range(len(names))]


def headers_of(spark: SparkSession, sizes: Mapping[str, int], sep: str = ",", header: bool = True, encoding: str = "UTF-8", **extra) -> dict[str, list[str]]:
    """Column names of many files (path and size), which tasks read: one job for all small ones, one for all others.

    What reaches the driver is the first record of each file.  A file without one has no columns.
    """
    if not splittable(extra, encoding) or any(o in extra for o in HEADER_OPTIONS):
        with ThreadPoolExecutor(HEADER_THREADS) as pool:
            return dict(zip(sizes, pool.map(lambda path: header_of(spark, path, sep, header, encoding, **extra), sizes)))
    dialect = Dialect.of(sep, extra, encoding)
    apart = spark.newSession()
    apart.conf.set("spark.sql.files.maxPartitionBytes", f"{ALONE}b")
    apart.conf.set("spark.sql.files.openCostInBytes", f"{ALONE}b")
    small = [p for p, n in sizes.items() if n <= SMALL_FILE]
    large = [p for p, n in sizes.items() if n > SMALL_FILE]
    found: dict[str, bytes] = {}
    for session, paths in ((spark, small), (apart, large)):
        if paths:
            found |= first_records(session, paths, dialect)

    def names(path: str) -> list[str]:
        if (record := found.get(qualified(spark, path))) is None:
            return []
        values = [v.decode(encoding, "replace") for v in dialect.fields(record)]
        return header_names(values) if header else [f"column_{i + 1}" for i in range(len(values))]

    return {path: names(path) for path in sizes}


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark reports it for rows, local files without a scheme."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    whole = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()
    return re.sub(r"^file:/+", "/", whole)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    header: bool = True,
    null_tokens: Sequence[str] = NULL_TOKENS,
    encoding: str = "UTF-8",
    names: Sequence[str] | None = None,
    keep_corrupt: bool = False,
    reader: dict | None = None,
    lineage: str | None = None,
) -> DataFrame:
    """Files with one common header, all columns text.

    Quotes inside quoted values are doubled.  Values with line breaks need
    ``reader={"multiLine": True}``; without it such rows are ragged ones.  Such files are
    read in byte ranges like all others, but for encodings of wide characters, own line
    separators and comments, where Spark reads a file in one task.  Long rows are cut, short rows padded with NULL, null tokens become NULL.
    ``keep_corrupt`` adds ``_corrupt_record`` with the raw line of such rows; the
    parser then has to look at all columns of every row, so it is off by default.
    ``lineage`` names a column for the path each row came from.
    """
    extra = dict(reader or {})
    paths = [path] if isinstance(path, str) else list(path)
    if names is None:
        names = header_of(spark, paths[0], sep, header, encoding, **extra)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    if str(extra.get("multiLine", False)).lower() == "true" and splittable(extra, encoding) and names:
        whole = schema.add(CORRUPT, T.StringType()) if keep_corrupt else schema
        options = {**extra, **({"columnNameOfCorruptRecord": CORRUPT} if keep_corrupt else {})}
        return blank_to_null(read_quoted(spark, paths, whole, sep, header, encoding, options, lineage), null_tokens, list(names))
    source = _reader(spark, sep, header, encoding, extra)
    if keep_corrupt:
        schema = schema.add(CORRUPT, T.StringType())
        source = source.option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False)
    df = source.schema(schema).csv(paths)
    if lineage:
        df = with_source_file(df, lineage)
    return blank_to_null(df, null_tokens, list(names))


def ragged_rows(df: DataFrame) -> DataFrame:
    """Rows whose field count was wrong: the raw line and what was kept of it.

    The filter names a data column as well, because Spark refuses to parse a file
    for its raw lines alone.
    """
    bad = F.col(CORRUPT).isNotNull()
    return df.filter(bad & F.coalesce(col(df.columns[0]), F.col(CORRUPT)).isNotNull())
