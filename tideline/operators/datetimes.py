"""Find the date columns of a table of text, choose their pattern, rewrite them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.dates import (
    COLUMN_PATTERNS,
    DATE_NAME_PARTS,
    DATE_TEXT,
    DATETIME_TEXT,
    date_family,
    date_like_name,
    date_like_text,
)
from tideline.functions.names import col
from tideline.functions.text import column_values, name_at, string_columns, strip

# A pattern with an optional fraction reads all that its plain twin reads and stands before it.
SHADOWED = ("iso_seconds", "month_first_seconds")


def datetime_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    name_parts: tuple[str, ...] = DATE_NAME_PARTS,
    min_share: float | None = None,
) -> DataFrame:
    """Per text column: is it a date column, by what, and which pattern reads it.

    All rows count, so the answer does not depend on row order.  Detection and
    all pattern counts share one pass; each task sends one row per column.

    Without ``min_share`` the first pattern that reads one value is the column's.
    With it, the pattern that reads most values is, ties by order, provided it
    reads that share of them: a few dates among other text change nothing, and day
    or month first is settled by the values that only one of them reads.
    """
    names = list(string_columns(df) if columns is None else columns)
    if not names:
        raise ValueError("the table has no text column to profile")
    text, family = F.col("text"), F.col("family")
    values = column_values(df, [strip(col(n)) for n in names]).select(
        "position", "text", date_family(text).alias("family"), F.coalesce(date_like_text(text), F.lit(False)).alias("looks")
    )
    counts = values.groupBy("position").agg(
        F.count(text).alias("n"),
        F.bool_or("looks").alias("looks"),
        *[
            (F.lit(0).cast("bigint") if p.name in SHADOWED else F.count(F.when(family == p.family, p.parse(text)))).alias(p.name)
            for p in COLUMN_PATTERNS
        ],
    )
    named = F.element_at(F.array(*[F.lit(date_like_name(n, name_parts)) for n in names]), F.col("position") + 1)
    flagged = F.col("flagged_by_name") | F.col("looks")
    hits = [(p, flagged & (F.col(p.name) > 0)) for p in COLUMN_PATTERNS]
    if min_share is not None:
        most = F.greatest(*[F.col(p.name) for p in COLUMN_PATTERNS])
        enough = flagged & (most > 0) & (most >= F.lit(min_share) * F.col("n"))
        hits = [(p, enough & (F.col(p.name) == most)) for p in COLUMN_PATTERNS]
    pattern = F.coalesce(*[F.when(hit, F.lit(p.name)) for p, hit in hits])
    parsed = F.coalesce(*[F.when(hit, F.col(p.name)) for p, hit in hits], F.lit(0).cast("bigint"))
    return counts.withColumn("flagged_by_name", named).select(
        name_at(names, F.col("position")).alias("column_name"),
        "flagged_by_name",
        F.col("looks").alias("flagged_by_content"),
        pattern.alias("pattern"),
        F.col("n").alias("non_null_count"),
        parsed.alias("parsed_count"),
        F.when(flagged, F.col("n") - parsed).otherwise(F.lit(0).cast("bigint")).alias("unparsed_count"),
    )


def found_patterns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    name_parts: tuple[str, ...] = DATE_NAME_PARTS,
    min_share: float | None = None,
) -> dict[str, tuple[str, int]]:
    """Column -> (pattern name, values it does not read), for the date columns.  One row per column is fetched."""
    names = list(string_columns(df) if columns is None else columns)
    if not names:
        return {}
    found = datetime_profile(df, names, name_parts, min_share).filter(F.col("pattern").isNotNull())
    rows = found.select("column_name", "pattern", "unparsed_count").collect()
    return {r["column_name"]: (r["pattern"], r["unparsed_count"]) for r in rows}


def choose_patterns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    name_parts: tuple[str, ...] = DATE_NAME_PARTS,
    min_share: float | None = None,
) -> dict[str, str]:
    """Column -> pattern name, for the date columns."""
    return {name: pattern for name, (pattern, _) in found_patterns(df, columns, name_parts, min_share).items()}


def rewrite_datetimes(
    df: DataFrame, choices: dict[str, str], on_unparsed: str = "null", keep_typed: bool = False
) -> DataFrame:
    """Rewrite the chosen columns to the common date text.

    Typed date and timestamp columns are rewritten too.  Text the chosen pattern
    does not read becomes NULL, or stays with ``on_unparsed="keep"``.
    ``keep_typed`` adds ``<name>__ts`` holding the full timestamp, seconds included.
    """
    if on_unparsed not in ("null", "keep"):
        raise ValueError("on_unparsed must be 'null' or 'keep'")
    patterns = {p.name: p for p in COLUMN_PATTERNS}
    # Stripped text and its timestamp are columns of their own, computed once.
    stripped = {n: strip(col(n)).alias(f"{n}__text") for n in choices}
    df_text = df.select("*", *stripped.values())
    parsed = {}
    for name, choice in choices.items():
        text = col(f"{name}__text")
        pattern = patterns[choice]
        parsed[name] = F.when(date_family(text) == pattern.family, pattern.parse(text)).alias(f"{name}__parsed")
    df_parsed = df_text.select("*", *parsed.values())
    out: list[Column] = []
    for f in df.schema.fields:
        c = col(f.name)
        typed = None
        if isinstance(f.dataType, T.DateType):
            typed, text = c.cast("timestamp"), F.date_format(c, DATE_TEXT)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            typed, text = c, F.date_format(c, DATETIME_TEXT)
        elif f.name in choices:
            typed = col(f"{f.name}__parsed")
            text = patterns[choices[f.name]].render(typed)
            if on_unparsed == "keep":
                text = F.coalesce(text, c)
        else:
            text = c
        out.append(text.alias(f.name))
        if keep_typed and typed is not None:
            out.append(typed.alias(f.name + "__ts"))
    return df_parsed.select(*out)


def normalize_datetimes(
    df: DataFrame,
    name_parts: tuple[str, ...] = DATE_NAME_PARTS,
    on_unparsed: str = "null",
    keep_typed: bool = False,
    min_share: float | None = None,
) -> DataFrame:
    """Detect, choose and rewrite in one call."""
    return rewrite_datetimes(df, choose_patterns(df, name_parts=name_parts, min_share=min_share), on_unparsed, keep_typed)
