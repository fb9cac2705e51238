"""Date and time text: patterns, detection, parsing, formatting."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.text import strip

# Output formats.
DATE_TEXT = "MM/dd/yyyy"
DATETIME_TEXT = "MM/dd/yyyy hh:mm a"
# A column whose lower-cased name contains one of these is a date column.
DATE_NAME_PARTS = ("date", "time", "_at", "_on", "created", "updated", "modified")


@dataclass(frozen=True)
class Pattern:
    """A parse pattern and the family text must belong to before it is tried."""

    name: str
    layout: str
    family: str
    date_only: bool

    def parse(self, text: Column) -> Column:
        return F.try_to_timestamp(text, F.lit(self.layout))

    def render(self, moment: Column) -> Column:
        return F.date_format(moment, DATE_TEXT if self.date_only else DATETIME_TEXT)


def _pattern(name: str, layout: str, family: str) -> Pattern:
    return Pattern(name, layout, family, "H" not in layout)


_FRACTION = "[.SSSSSSSSS]"
# A column takes the first of these that reads at least one value.
COLUMN_PATTERNS = (
    _pattern("iso_fraction", "yyyy-M-d H:m:s" + _FRACTION, "iso_time"),
    _pattern("iso_seconds", "yyyy-M-d H:m:s", "iso_time"),
    _pattern("iso_date", "yyyy-M-d", "iso_date"),
    _pattern("month_first_fraction", "M/d/yyyy H:m:s" + _FRACTION, "slash_time"),
    _pattern("month_first_seconds", "M/d/yyyy H:m:s", "slash_time"),
    _pattern("month_first_date", "M/d/yyyy", "slash_date"),
    _pattern("day_first_date", "d/M/yyyy", "slash_date"),
    _pattern("compact_date", "yyyyMMdd", "compact"),
)
# A single value takes the first of these that reads it.
VALUE_PATTERNS = (
    _pattern("iso_date", "yyyy-M-d", "iso_date"),
    _pattern("iso_seconds", "yyyy-M-d H:m:s", "iso_time"),
    _pattern("iso_fraction", "yyyy-M-d H:m:s" + _FRACTION, "iso_time"),
    _pattern("month_first_date", "M/d/yyyy", "slash_date"),
    _pattern("month_first_seconds", "M/d/yyyy H:m:s", "slash_time"),
    _pattern("day_first_date", "d/M/yyyy", "slash_date"),
    _pattern("day_first_seconds", "d/M/yyyy H:m:s", "slash_time"),
    _pattern("day_first_dash_date", "d-M-yyyy", "dash_date"),
    _pattern("day_first_dash_seconds", "d-M-yyyy H:m:s", "dash_time"),
)
# Shortest and longest text any pattern reads: 1/1/2025, and nine fraction digits.
SHORTEST, LONGEST = 8, 29


def by_family(text: Column, result: Callable[[str], Column]) -> Column:
    """What ``result`` gives for the family of stripped text; NULL if it has none.

    A few character tests keep the parsers, which are far slower, away from text
    they would refuse.
    """
    plausible = F.char_length(text).between(SHORTEST, LONGEST) & F.substring(text, 1, 1).between("0", "9")
    iso = F.substring(text, 5, 1) == "-"
    clock, slash, dash = (F.contains(text, F.lit(mark)) for mark in ":/-")
    return F.when(
        plausible,
        F.when(iso, F.when(clock, result("iso_time")).otherwise(result("iso_date")))
        .when(slash, F.when(clock, result("slash_time")).otherwise(result("slash_date")))
        .when(dash, F.when(clock, result("dash_time")).otherwise(result("dash_date")))
        .when(F.char_length(text) == SHORTEST, result("compact")),
    )


def date_family(text: Column) -> Column:
    """Name of the patterns' family that could read this stripped text."""
    return by_family(text, F.lit)


def date_like_name(name: str, parts: tuple[str, ...] = DATE_NAME_PARTS) -> bool:
    lowered = name.strip().lower()
    return any(part in lowered for part in parts)


def date_like_text(text: Column) -> Column:
    """Eight or more characters (stripped), with a digit and a date or time separator."""
    return (F.char_length(text) >= SHORTEST) & text.rlike(r"\d") & text.rlike(r"[-/ :]")


def parse_text(text: Column) -> Column:
    """Timestamp by the first value pattern that reads the stripped text, else NULL."""

    def parsed(family: str) -> Column:
        tried = [p.parse(text) for p in VALUE_PATTERNS if p.family == family]
        return F.coalesce(*tried) if tried else F.lit(None).cast("timestamp")

    return by_family(text, parsed)


def parse_any(c: Column) -> Column:
    """:func:`parse_text` of text that may have white space around it."""
    return parse_text(strip(c))


def to_moment(c: Column, data_type: T.DataType) -> Column:
    """Timestamp from text, date, timestamp or epoch seconds."""
    if isinstance(data_type, T.StringType):
        return parse_any(c)
    if isinstance(data_type, T.NumericType):
        return F.timestamp_seconds(F.nanvl(c.cast("double"), F.lit(None).cast("double")))
    return c.try_cast("timestamp")
