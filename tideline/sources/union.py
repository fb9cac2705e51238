"""Lineage of rows, and union of tables by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.names import col

LINEAGE = "_source_file"


def source_path(file_path: Column) -> Column:
    """A file's plain path from Spark's file URI (local files lose the scheme)."""
    plain = F.regexp_replace(file_path, r"^file:(//(?=/))?", "")
    return F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))


def with_source_file(df: DataFrame, name: str = LINEAGE) -> DataFrame:
    """Add the path each row was read from."""
    return df.select(*[col(c) for c in df.columns], source_path(F.col("_metadata.file_path")).alias(name))


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns a frame lacks are NULL, lineage comes last.

    Frames should be text already: mixed types of one name would be widened.
    """
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if LINEAGE in df.columns:
        df = df.select(*[col(c) for c in df.columns if c != LINEAGE], LINEAGE)
    return df
