"""Table targets: files Spark reads back, with row counts taken in the write pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tideline.functions.names import col
from tideline.functions.text import as_text, row_text

# replace: drop what is there; fail: refuse if something is there.
MODES = {"replace": "overwrite", "fail": "errorifexists", "append": "append"}
ROW_ID = "U_ID"
OUTCOME = "outcome"
BATCH_LIMITS = (1, 100_000)


def check_batch_size(size: int) -> int:
    low, high = BATCH_LIMITS
    if not isinstance(size, int) or not low <= size <= high:
        raise ValueError(f"batch size must be between {low} and {high}, got {size!r}")
    return size


def write_table(
    df: DataFrame, path: str, mode: str = "replace", fmt: str = "parquet", partition_by: Sequence[str] = (), **options
) -> int:
    """Write and return the number of rows written, counted while writing."""
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}, expected one of {tuple(MODES)}")
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(MODES[mode]).format(fmt).options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
    return seen.get["rows"]


def write_delimited(df: DataFrame, path: str, mode: str = "replace", header: bool = True, sep: str = ",", **options) -> int:
    """Delimited export.  NULL and empty text stay apart: NULL is written as nothing."""
    return write_table(df, path, mode, "csv", header=header, sep=sep, emptyValue='""', **options)


def write_database(df: DataFrame, url: str, table: str, mode: str = "replace", batch_size: int = 1000, connections: int = 16, **options) -> None:
    """Batched insert over JDBC.

    Each partition commits on its own, so load a staging table and swap it in.
    """
    (
        df.write.format("jdbc").mode(MODES[mode])
        .options(url=url, dbtable=table, batchsize=check_batch_size(batch_size), numPartitions=connections, **options)
        .save()
    )


def count_matches(spark: SparkSession, path: str, expected: int, fmt: str = "parquet") -> bool:
    """Does the written table hold as many rows as the write pass counted?"""
    return spark.read.format(fmt).load(path).count() == expected


def row_id(df: DataFrame, deterministic: bool = False) -> Column:
    """Surrogate row id: a random UUID, or a hash of the row (equal rows, equal ids)."""
    if not deterministic:
        return F.uuid()
    texts = [F.coalesce(as_text(col(f.name), f.dataType), F.lit("")) for f in df.schema.fields]
    return F.md5(row_text(texts))


def with_row_id(df: DataFrame, deterministic: bool = False) -> DataFrame:
    """The id comes first.  Add random ids last: nothing may shuffle them after."""
    return df.select(row_id(df, deterministic).alias(ROW_ID), *[col(c) for c in df.columns])


def write_with_rejects(converted: DataFrame, path: str, mode: str = "replace") -> None:
    """Good and rejected rows in one pass, as two partitions of one table."""
    from tideline.operators.rejects import REASONS

    split = F.when(F.col(REASONS) == "", F.lit("good")).otherwise(F.lit("rejected"))
    write_table(converted.withColumn(OUTCOME, split), path, mode, partition_by=[OUTCOME])


def read_good(spark: SparkSession, path: str) -> DataFrame:
    from tideline.operators.rejects import REASONS, SOURCE_ROW

    df = spark.read.parquet(path)
    return df.filter(F.col(OUTCOME) == "good").drop(OUTCOME, REASONS, SOURCE_ROW)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    from tideline.operators.rejects import REASONS, SOURCE_ROW

    return spark.read.parquet(path).filter(F.col(OUTCOME) == "rejected").select(REASONS, SOURCE_ROW)
