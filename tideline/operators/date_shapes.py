"""Date layouts read from the data: digit shapes are counted, and the order of day, month and year is solved from ranges.

A text's shape has ``#`` for each run of digits.  Texts of one shape have the same numbers in the
same places, so the least and greatest value of each place say what it can be: a
place above 31 is no day, one above 12 is no month.  No list of patterns is tried on rows.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tideline.functions.dates import DATE_TEXT, DATETIME_TEXT
from tideline.functions.names import col
from tideline.functions.text import column_values, string_columns, strip

# Shortest and longest text that is looked at, and the marks that may stand between its numbers.
SHORTEST, LONGEST = 8, 32
MARKS = r"^\d+([-/. T:,]{1,2}\d+){2,6}( ?[AaPp][Mm])?Z?$|^\d{8}$|^\d{14}$"
PLACES = 7
# Letters of Spark's layouts with the least and greatest value of each field.
FIELDS = {"y": (1000, 9999), "M": (1, 12), "d": (1, 31), "H": (0, 23), "h": (1, 12), "m": (0, 59), "s": (0, 59)}
# Which orders of year, month and day are in use; where values leave several, the separator's usual one comes first.
ORDERS = ("yMd", "dMy", "Mdy", "ydM")
USUAL = {"/": "Mdy", ".": "dMy", "-": "yMd"}
SOLID = {"99999999": (4, 2, 2), "99999999999999": (4, 2, 2, 2, 2, 2)}


def shape_of(text: Column) -> Column:
    """``#`` for each run of digits, ``AM`` for both halves of the day; text of digits only keeps its length."""
    marked = F.regexp_replace(F.upper(F.regexp_replace(text, r"\d+", "#")), "PM", "AM")
    return F.when(text.rlike(r"^\d+$"), F.regexp_replace(text, r"\d", "9")).otherwise(marked)


def shape_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``position, shape, n, low, high, width`` of the texts that could be dates, and one row (shape NULL) of all others.

    One pass; tasks combine, and there are few shapes, since letters other than ``AM`` and ``PM`` make a text another one.
    """
    text = F.col("text")
    values = column_values(df, [strip(col(n)) for n in columns]).where(text.isNotNull() & (text != ""))
    like = F.char_length(text).between(SHORTEST, LONGEST) & text.rlike(MARKS)
    solid = text.rlike(r"^\d+$")
    cut = F.when(F.char_length(text) == 8, F.regexp_replace(text, r"^(\d{4})(\d\d)(\d\d)$", "$1 $2 $3")).otherwise(
        F.regexp_replace(text, r"^(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)$", "$1 $2 $3 $4 $5 $6")
    )
    split = values.select("position", F.when(like, shape_of(text)).alias("shape"), F.when(like, F.split(F.when(solid, cut).otherwise(text), r"[^\d]+")).alias("parts"))
    number = lambda k: F.get("parts", F.lit(k))
    aggregates = [F.count(F.lit(1)).alias("n")]
    for k in range(PLACES):
        value = F.nullif(number(k), F.lit("")).try_cast("int")
        aggregates += [F.min(value).alias(f"low{k}"), F.max(value).alias(f"high{k}"), F.min(F.char_length(number(k))).alias(f"width{k}"), F.max(F.char_length(number(k))).alias(f"wide{k}")]
    return split.groupBy("position", "shape").agg(*aggregates)


def solve(shape: str, places: Sequence[tuple[int, int, int, int]]) -> str | None:
    """Spark's layout of a shape whose places have these least and greatest values and widths; None if there is none."""

    def fits(letter: str, place: tuple[int, int, int, int]) -> bool:
        low, high, narrow, wide = place
        least, most = FIELDS[letter]
        return least <= low and high <= most and (narrow == wide == 4 if letter == "y" else wide <= 2)

    if shape in SOLID:
        letters = "yMdHms"[: len(SOLID[shape])]
        if len(places) < len(letters) or not all(map(fits, letters, places)):
            return None
        return "".join(x * w for x, w in zip(letters, SOLID[shape]))
    marks = re.findall(r"[^#]+", shape)
    half = shape.rstrip("Z").endswith("M")
    tail = marks.pop() if not shape.endswith("#") else ""
    if len(places) != len(marks) + 1 or len(places) < 3 or marks[0] != marks[1] or (tail.rstrip("Z") and not half):
        return None
    usual = USUAL.get(marks[0][:1], "yMd")
    found = [o for o in sorted(ORDERS, key=lambda o: o != usual) if all(map(fits, o, places))]
    if not found:
        return None
    time = places[3:]
    hour = "h" if half else "H"
    letters = f"{hour}ms"[: len(time)]
    if len(time) == 1 or (half and not time) or not all(map(fits, letters, time)):
        return None
    if any(m != ":" for m in marks[3:5]) or (len(time) == 4 and marks[5] != ".") or len(time) > 4:
        return None
    letters = [*("yyyy" if x == "y" else x for x in found[0]), *letters, *(["S" * time[3][3]] if len(time) == 4 else [])]
    if len(time) == 4 and time[3][2] != time[3][3]:
        letters[-1] = "SSSSSSSSS"
    quoted = [m.replace("T", "'T'") for m in marks]
    out = "".join(itertools.chain.from_iterable(itertools.zip_longest(letters, quoted, fillvalue="")))
    if len(time) == 4 and time[3][2] != time[3][3]:
        out = out.replace(".SSSSSSSSS", "[.SSSSSSSSS]")
    return out + tail.replace("AM", "a").replace("Z", "'Z'")


def datetime_shapes(df: DataFrame, columns: Sequence[str] | None = None, min_share: float = 0.9) -> dict[str, dict[str, str]]:
    """Column -> shape -> layout, of the columns in which solved shapes cover ``min_share`` of the texts.

    What reaches the driver is a row for each column and shape.
    """
    names = list(string_columns(df) if columns is None else columns)
    if not names:
        return {}
    rows: dict[int, list[Row]] = {}
    for r in shape_counts(df, names).collect():
        rows.setdefault(r["position"], []).append(r)
    out = {}
    for position, own in rows.items():
        layouts, read = {}, 0
        for r in own:
            if r["shape"] is None:
                continue
            places = [(r[f"low{k}"], r[f"high{k}"], r[f"width{k}"], r[f"wide{k}"]) for k in range(PLACES) if r[f"low{k}"] is not None]
            layout = solve(r["shape"], places)
            if layout:
                layouts[r["shape"]] = layout
                read += r["n"]
        if layouts and read >= min_share * sum(r["n"] for r in own):
            out[names[position]] = layouts
    return out


def rewrite_by_shape(df: DataFrame, layouts: dict[str, dict[str, str]], on_unparsed: str = "keep") -> DataFrame:
    """The columns' dates in the common text form, each text by its shape's layout."""
    if on_unparsed not in ("null", "keep"):
        raise ValueError("on_unparsed must be 'null' or 'keep'")
    out = []
    for name in df.columns:
        if name not in layouts:
            out.append(col(name))
            continue
        text = strip(col(name))
        result = F.lit(None).cast("string")
        for key, layout in layouts[name].items():
            moment = F.try_to_timestamp(F.upper(text) if layout.endswith("a") else text, F.lit(layout))
            timed = any(x in layout for x in "Hh")
            result = F.when(shape_of(text) == key, F.date_format(moment, DATETIME_TEXT if timed else DATE_TEXT)).otherwise(result)
        out.append((F.coalesce(result, col(name)) if on_unparsed == "keep" else result).alias(name))
    return df.select(*out)
