"""Typed conversion with rejects: bad rows leave with their reasons, the rest load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.convert import TEXT_LIMIT, convert, full_text
from tideline.functions.names import col
from tideline.functions.text import strip

REASONS = "_reject_reasons"
SOURCE_ROW = "_source_row"


def _reason(c: Column, data_type: T.DataType, converted: Column, kind: str, name: str, text_limit: int | None) -> Column:
    """Why this value cannot load; NULL if it can."""
    if kind == "text":
        if text_limit is None:
            return F.lit(None).cast("string")
        too_long = F.char_length(full_text(c, data_type)) > text_limit
        return F.when(too_long, F.lit(f"{name}:too_long"))
    given = c.isNotNull()
    if isinstance(data_type, T.StringType):
        given = given & (strip(c) != "")
    elif isinstance(data_type, (T.FloatType, T.DoubleType)):
        given = given & ~F.isnan(c)
    return F.when(converted.isNull() & given, F.lit(f"{name}:not_{kind}"))


def convert_table(df: DataFrame, targets: dict[str, str], text_limit: int | None = TEXT_LIMIT) -> DataFrame:
    """Convert the named columns; add the reasons and the row as it came.

    Columns without a target kind pass unchanged.  ``_source_row`` is JSON of the
    original values, filled for rejected rows only.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    done = {n: f"__{i}" for i, n in enumerate(targets)}
    # Converted values and reasons are columns of their own, computed once.
    staged = df.select("*", *[convert(col(n), types[n], k, text_limit).alias(done[n]) for n, k in targets.items()])
    reasons = [_reason(col(n), types[n], F.col(done[n]), k, n, text_limit) for n, k in targets.items()]
    staged = staged.withColumn(REASONS, F.concat_ws(";", *reasons))
    original = F.to_json(F.struct(*[col(n) for n in df.columns]), {"ignoreNullFields": "false"})
    return staged.select(
        *[(F.col(done[n]) if n in done else col(n)).alias(n) for n in df.columns],
        F.col(REASONS),
        F.when(F.col(REASONS) != "", original).alias(SOURCE_ROW),
    )


def good_rows(converted: DataFrame) -> DataFrame:
    return converted.filter(F.col(REASONS) == "").drop(REASONS, SOURCE_ROW)


def rejected_rows(converted: DataFrame) -> DataFrame:
    """Reasons and original rows of what did not convert."""
    return converted.filter(F.col(REASONS) != "").select(REASONS, SOURCE_ROW)
