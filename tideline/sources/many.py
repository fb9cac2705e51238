"""Several files as one table: union by column name, with lineage."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.names import col
from tideline.functions.text import blank_to_null, stringify
from tideline.sources.delimited import header_of, headers_of, read_delimited, split_options
from tideline.sources.typed import read_typed
from tideline.sources.union import LINEAGE, union_by_name, with_source_file

HEADER_THREADS = 16
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # how Spark writes a null into a folder's name


class MissingFiles(FileNotFoundError):
    """Source files a spec names that are not there."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder, on whatever file system the path names?"""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def _hidden(name: str) -> bool:
    """What Spark's readers pass over."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _listed(spark: SparkSession, path: str) -> dict[str, tuple[tuple[str, ...], int]]:
    """The files that a folder or pattern stands for, at any depth, with the names of their partition columns and their sizes."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(target) or []
    if len(found) == 1 and found[0].isFile():
        return {path: ((), found[0].getLen())}
    files: dict[str, tuple[tuple[str, ...], int]] = {}

    def walk(status, keys: tuple[str, ...]) -> None:
        for f in system.listStatus(status.getPath()):
            name = f.getPath().getName()
            if _hidden(name):
                continue
            if f.isFile():
                files[re.sub(r"^file:/+", "/", str(f.getPath()))] = keys, f.getLen()
            else:
                key = name.partition("=")[0] if "=" in name else ""
                walk(f, (*keys, key) if key and key not in keys else keys)

    for status in found:
        if not status.isFile():
            walk(status, ())
        elif not _hidden(status.getPath().getName()):
            files[re.sub(r"^file:/+", "/", str(status.getPath()))] = (), status.getLen()
    return dict(sorted(files.items()))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The files that a folder or pattern stands for, at any depth; a plain file is itself."""
    return list(_listed(spark, path))


def file_sizes(spark: SparkSession, paths: Sequence[str]) -> dict[str, int]:
    """The files that folders and patterns stand for, with their sizes."""
    return {file: size for p in paths for file, (_, size) in _listed(spark, p).items()}


def file_states(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Size and time of change of the files that a path stands for."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = {}
    for file, (_, size) in _listed(spark, path).items():
        where = target(file)
        status = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where)
        out[file] = (size, status.getModificationTime())
    return out


def resolve_files(spark: SparkSession, files: str | Sequence[str], data_dir: str | None = None) -> list[str]:
    """Absolute paths; relative ones lie under ``data_dir``.  Any missing file is an error."""
    names = [files] if isinstance(files, str) else list(files)
    if not names:
        raise MissingFiles("no source file is named")
    paths = [n if os.path.isabs(n) or "://" in n or not data_dir else f"{data_dir.rstrip('/')}/{n}" for n in names]
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise MissingFiles(f"files not found: {missing}")
    return paths


def _grouped(paths: Sequence, shape: Callable[..., tuple]) -> list[tuple[tuple, list]]:
    """Paths by their shape, in order of first appearance.

    The union then has one branch per distinct header, not one per file, so
    thousands of like files stay one scan.
    """
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        shapes = list(pool.map(shape, paths))
    groups: dict[tuple, list[str]] = {}
    for path, key in zip(paths, shapes):
        groups.setdefault(key, []).append(path)
    return list(groups.items())


def _with_partitions(df: DataFrame, keys: Sequence[str], null_tokens: Sequence[str]) -> DataFrame:
    """Values that the folders' names hold (``country=de``); they stand for a file's own column of that name, as in Spark."""
    for key in keys:
        value = F.regexp_extract(LINEAGE, f"^.*/{re.escape(key)}=([^/]*)/", 1)
        value = F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)
        name = next((c for c in df.columns if c.lower() == unquote(key).lower()), unquote(key))
        df = df.withColumn(name, F.nullif(value, F.lit(NO_VALUE)))
    df = df.select(*[col(c) for c in df.columns if c != LINEAGE], LINEAGE)
    return blank_to_null(df, null_tokens, [c for c in df.columns if c != LINEAGE])


def read_delimited_files(spark: SparkSession, paths: Sequence[str], options: dict | None = None) -> DataFrame:
    """Delimited files whose headers may differ, all text, with their path.

    Folders and patterns stand for their files, at any depth, whose headers may differ
    as well; partition folders (``country=de``) give columns.  A path without files is
    left to Spark, which refuses it.  A file that several paths name is read for each.
    """
    o = split_options(options)
    files = []
    for p in paths:
        found = _listed(spark, p)
        if not found:
            header_of(spark, p, o["sep"], o["header"], o["encoding"], **o["reader"])  # Spark refuses it
        files += found.items()
    headers = headers_of(spark, {path: size for path, (_, size) in files}, o["sep"], o["header"], o["encoding"], **o["reader"])
    groups: dict[tuple, list[str]] = {}
    for path, (keys, _) in files:
        groups.setdefault((tuple(headers[path]), keys), []).append(path)
    frames = []
    for (names, keys), group in groups.items():
        df = read_delimited(spark, group, o["sep"], o["header"], (), o["encoding"], names, reader=o["reader"], lineage=LINEAGE)
        frames.append(_with_partitions(df, keys, o["null_tokens"]))
    return union_by_name(frames)


def typed_groups(spark: SparkSession, paths: Sequence[str], fmt: str) -> list[list[str]]:
    """Typed files by their columns and types."""

    def shape(path: str) -> tuple:
        return tuple((f.name, f.dataType.simpleString()) for f in read_typed(spark, path, fmt).schema.fields)

    return [group for _, group in _grouped(paths, shape)]


def read_typed_files(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", decimals: dict[str, int] | None = None) -> DataFrame:
    """Typed files whose columns may differ, turned to text, with their path."""
    frames = []
    for group in typed_groups(spark, paths, fmt):
        df = with_source_file(read_typed(spark, group, fmt), LINEAGE)
        frames.append(stringify(df, {k: v for k, v in (decimals or {}).items() if k in df.columns}))
    return union_by_name(frames)
