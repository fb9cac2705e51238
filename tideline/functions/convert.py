"""Value conversion on the way to a typed target; failures become NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.dates import to_moment
from tideline.functions.text import as_text, text_to_double

# Fixed values.
TEXT_LIMIT = 4000
TRUE_WORDS = ("true", "1", "yes", "y")

KINDS = ("text", "integer", "float", "flag", "timestamp")
_FLOATS = (T.FloatType, T.DoubleType)


def full_text(c: Column, data_type: T.DataType) -> Column:
    """Text of any value: whole floats without ``.0``, NaN as empty."""
    if isinstance(data_type, _FLOATS):
        d = c.cast("double")
        whole = (d == F.floor(d)) & (F.abs(d) < 1e18)
        return (
            F.when(F.isnan(d), F.lit(""))
            .when(whole, d.try_cast("bigint").cast("string"))
            .otherwise(c.cast("string"))
        )
    return as_text(c, data_type)


def to_text(c: Column, data_type: T.DataType, limit: int | None = TEXT_LIMIT) -> Column:
    """Text cut to the target's column limit (None: no limit)."""
    text = full_text(c, data_type)
    return text if limit is None else F.substring(text, 1, limit)


def to_integer(c: Column, data_type: T.DataType) -> Column:
    """Whole number; ``123.0`` and ``123.9`` give 123.

    Text is first read exactly, so large keys do not pass through a double.
    """
    if isinstance(data_type, T.StringType):
        return F.coalesce(c.try_cast("bigint"), text_to_double(c).try_cast("bigint"))
    return c.try_cast("bigint")


def to_float(c: Column, data_type: T.DataType) -> Column:
    """Double; NaN has no place in the target and becomes NULL."""
    number = text_to_double(c) if isinstance(data_type, T.StringType) else c.try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def to_flag(c: Column, data_type: T.DataType) -> Column:
    """1 or 0; for text, 1 is one of the truthy words.  NULL stays NULL."""
    if isinstance(data_type, T.StringType):
        return F.lower(c).isin(*TRUE_WORDS).cast("int")
    if isinstance(data_type, T.BooleanType):
        return c.cast("int")
    return (c != 0).cast("int")


def convert(c: Column, data_type: T.DataType, kind: str, text_limit: int | None = TEXT_LIMIT) -> Column:
    """Convert one column to a target kind; text is cut at the limit (None: whole)."""
    if kind == "text":
        return to_text(c, data_type, text_limit)
    if kind == "integer":
        return to_integer(c, data_type)
    if kind == "float":
        return to_float(c, data_type)
    if kind == "flag":
        return to_flag(c, data_type)
    if kind == "timestamp":
        return to_moment(c, data_type)
    raise ValueError(f"unknown target kind {kind!r}, expected one of {KINDS}")
