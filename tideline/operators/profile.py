"""Column profiles.  Each is one aggregate over the table: no shuffle of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.convert import TEXT_LIMIT, convert, full_text
from tideline.functions.dates import parse_text
from tideline.functions.names import col
from tideline.functions.text import column_values, name_at, string_columns, strip, text_to_double

# Width rules of the target.
UNKNOWN_WIDTH = 255
NARROWEST = 1000
FIXED_WIDTH_MIN, FIXED_WIDTH_MAX, FIXED_WIDTH_UNKNOWN = 10, 254, 50

VALUE_KINDS = ("integer", "decimal", "date", "text")


def _rows_from_one(df: DataFrame, aggregates: list[Column], rows: list[Column]) -> DataFrame:
    """A one-row aggregate turned into one row per column."""
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def recommended_width(longest: Column) -> Column:
    """Column width for a longest value: headroom, then the target's bounds."""
    n = longest.cast("double")
    room = (
        F.when(n <= 50, F.lit(255.0))
        .when(n <= 100, n * 2)
        .when(n <= 500, n * F.lit(1.5))
        .otherwise(n * F.lit(1.2))
    )
    bounded = F.least(F.greatest(room, F.lit(float(NARROWEST))), F.lit(float(TEXT_LIMIT)))
    return F.when(longest.isNull(), F.lit(UNKNOWN_WIDTH)).otherwise(F.floor(bounded)).cast("bigint")


def width_profile(df: DataFrame) -> DataFrame:
    """Longest value and recommended width of every text column."""
    names = string_columns(df)
    aggregates = [F.max(F.char_length(col(n))).cast("bigint").alias(f"m{i}") for i, n in enumerate(names)]
    rows = [
        F.struct(
            F.lit(n).alias("column_name"),
            F.col(f"m{i}").alias("max_length"),
            recommended_width(F.col(f"m{i}")).alias("recommended_width"),
            F.greatest(recommended_width(F.col(f"m{i}")), F.lit(NARROWEST)).alias("declared_width"),
        )
        for i, n in enumerate(names)
    ]
    return _rows_from_one(df, aggregates, rows)


def field_spec(df: DataFrame) -> DataFrame:
    """Fixed-width field per column: type letter, length, decimals, in column order."""
    aggregates, rows = [F.lit(1).alias("one")], []
    for i, f in enumerate(df.schema.fields):
        if isinstance(f.dataType, T.IntegralType):
            kind, length, decimals = "N", F.lit(10), 0
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            kind, length, decimals = "N", F.lit(15), 2
        elif isinstance(f.dataType, T.BooleanType):
            kind, length, decimals = "L", F.lit(1), 0
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            kind, length, decimals = "D", F.lit(8), 0
        else:
            longest = F.max(F.char_length(full_text(col(f.name), f.dataType)))
            aggregates.append(F.coalesce(longest, F.lit(FIXED_WIDTH_UNKNOWN)).alias(f"m{i}"))
            length = F.least(F.greatest(F.col(f"m{i}"), F.lit(FIXED_WIDTH_MIN)), F.lit(FIXED_WIDTH_MAX))
            kind, decimals = "C", 0
        rows.append(
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("field_name"),
                F.lit(kind).alias("field_type"),
                length.cast("int").alias("length"),
                F.lit(decimals).alias("decimals"),
            )
        )
    return _rows_from_one(df, aggregates, rows)


def value_kind(text: Column) -> Column:
    """What one value's stripped text looks like; NULL for NULL."""
    return (
        F.when(text.rlike(r"^[+-]?\d+$"), F.lit("integer"))
        .when(text_to_double(text).isNotNull(), F.lit("decimal"))
        .when(parse_text(text).isNotNull(), F.lit("date"))
        .when(text.isNotNull(), F.lit("text"))
    )


def _with_kinds(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The frame with ``k0``, ``k1`` ... : what each named column's values look like."""
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [strip(full_text(col(n), types[n])).alias(f"t{i}") for i, n in enumerate(names)]
    return df.select("*", *texts).select("*", *[value_kind(F.col(f"t{i}")).alias(f"k{i}") for i in range(len(names))])


def type_profile(df: DataFrame) -> DataFrame:
    """Per column: how many values look like integers, decimals, dates, text.

    ``is_mixed`` marks columns whose values do not all look alike.
    """
    texts = [strip(full_text(col(f.name), f.dataType)) for f in df.schema.fields]
    kinds = column_values(df, texts).select("position", value_kind(F.col("text")).alias("kind"))
    counts = {k: F.count_if(F.col("kind") == k) for k in VALUE_KINDS}
    found = kinds.groupBy("position").agg(
        F.count("kind").alias("non_null_count"), *[n.alias(f"{k}_count") for k, n in counts.items()]
    )
    seen = sum(((F.col(f"{k}_count") > 0).cast("int") for k in VALUE_KINDS), F.lit(0))
    return found.select(
        name_at(df.columns, F.col("position")).alias("column_name"),
        "non_null_count",
        *[f"{k}_count" for k in VALUE_KINDS],
        (seen > 1).alias("is_mixed"),
    )


def conversion_stats(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """Counts of (column, looks like, becomes) for a planned conversion.

    ``becomes`` is the target kind, or ``null`` where the value does not convert.
    The combinations are few and known, so they are counted in place.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    marks, aggregates, rows = [], [], []
    for i, (name, kind) in enumerate(targets.items()):
        marks += [F.col(f"k{i}"), convert(col(name), types[name], kind).isNotNull().alias(f"v{i}")]
        for source in VALUE_KINDS:
            for becomes, converted in ((kind, True), ("null", False)):
                label = f"c{i}_{source}_{converted}"
                aggregates.append(
                    F.count_if((F.col(f"k{i}") == source) & (F.col(f"v{i}") == F.lit(converted))).alias(label)
                )
                rows.append(
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.lit(source).alias("from_kind"),
                        F.lit(becomes).alias("to_kind"),
                        F.col(label).alias("n_values"),
                    )
                )
    return _rows_from_one(_with_kinds(df, list(targets)).select(*marks), aggregates, rows).filter(F.col("n_values") > 0)
