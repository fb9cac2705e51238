"""Typed tables (parquet, orc, json): read with their types, or as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tideline.functions.text import stringify

FORMATS = ("parquet", "orc", "json")


def read_typed(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", columns: Sequence[str] | None = None, **options
) -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"unknown typed format {fmt!r}, expected one of {FORMATS}")
    df = spark.read.format(fmt).options(**options).load(path if isinstance(path, str) else list(path))
    return df.select(*columns) if columns else df


def read_typed_as_text(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    columns: Sequence[str] | None = None,
    decimals: dict[str, int] | None = None,
    **options,
) -> DataFrame:
    """Typed read, then every column as text."""
    return stringify(read_typed(spark, path, fmt, columns, **options), decimals)


