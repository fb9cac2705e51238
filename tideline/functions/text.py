"""Text forms: trimming, null words, stringifying, comparison text, row digests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.names import col

# Tokens that mean "no value" in delimited files.
NULL_TOKENS = ("", "NULL", "null", "NA", "N/A", "n/a")
# Spellings of "no value" left behind by casting to text.
NULL_WORDS = ("nan", "NaN", "<NA>", "None", "null", "NULL")

# Every character Unicode calls white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NESTED = (T.ArrayType, T.MapType, T.StructType)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any kind.

    ``btrim`` with a character set is linear in the text, stays in generated code
    and mentions its input once; plain ``trim`` would leave tabs and a regular
    expression backtracks.
    """
    return F.btrim(c, F.lit(WHITESPACE))


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = string_columns(df) if columns is None else columns
    return df.withColumns({n: strip(col(n)) for n in names}) if names else df


def blank_to_null(
    df: DataFrame, tokens: Sequence[str] = NULL_TOKENS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Exact null tokens become NULL in string columns."""
    names = string_columns(df) if columns is None else columns
    if not names or not tokens:
        return df
    return df.withColumns({n: F.when(~col(n).isin(*tokens), col(n)) for n in names})


def as_text(c: Column, data_type: T.DataType) -> Column:
    """Text of one value; nested values as compact JSON."""
    if isinstance(data_type, NESTED):
        return F.to_json(c)
    if isinstance(data_type, T.StringType):
        return c
    return c.cast("string")


def stringify(df: DataFrame, decimals: dict[str, int] | None = None) -> DataFrame:
    """Every column as text.

    ``decimals`` names floating columns to be written with a fixed number of
    digits (money), because the text of a double switches to exponents.
    """
    decimals = decimals or {}
    out = []
    for field in df.schema.fields:
        c = col(field.name)
        if field.name in decimals:
            c = c.cast(T.DecimalType(38, decimals[field.name]))
            out.append(c.cast("string").alias(field.name))
        else:
            out.append(as_text(c, field.dataType).alias(field.name))
    return df.select(*out)


def nested_to_text(df: DataFrame) -> DataFrame:
    """Array, map and struct columns as JSON text; other columns untouched."""
    nested = {f.name: F.to_json(col(f.name)) for f in df.schema.fields if isinstance(f.dataType, NESTED)}
    return df.withColumns(nested) if nested else df


def column_values(df: DataFrame, texts: Sequence[Column]) -> DataFrame:
    """One row per row and column: the column's ``position`` and its ``text``.

    What follows is then written once instead of once per column, so generated
    code stays small however wide the table is.
    """
    cells = [F.struct(F.lit(i).alias("position"), t.alias("text")) for i, t in enumerate(texts)]
    return df.select(F.inline(F.array(*cells)))


def name_at(names: Sequence[str], position: Column) -> Column:
    """The name of the column at a position."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position + 1)


def homogenize(df: DataFrame, decimals: dict[str, int] | None = None) -> DataFrame:
    """Every value text, stripped, empty as NULL; the declared column order is kept."""
    text = stringify(df, decimals)
    return text.select(*[F.nullif(strip(col(n)), F.lit("")).alias(n) for n in text.columns])


def text_to_double(text: Column) -> Column:
    """Double, or NULL.  Only text that starts like one is cast: a failed cast is slow."""
    return F.when(text.rlike(r"^\s*[-+]?(\.?[0-9]|(?i:inf|nan))"), text.try_cast("double"))


def whole_number_text(text: Column, keep_leading_zeros: bool = True) -> Column:
    """Legacy spelling of numbers in stripped text: ``12.0`` and ``1e2`` lose their dressing.

    Exact up to 28 integer digits; other text passes unchanged, empty as NULL.
    Codes such as ``007`` are kept unless asked otherwise.
    """
    # Plain digits need no work, so only dressed numbers are ever cast.
    dressed = r"^[-+]?[0-9]*(\.[0-9]*)?([eE][-+]?[0-9]+)?$"
    plain = r"^-?(0|[1-9][0-9]*)$" if not keep_leading_zeros else r"^-?([0-9]+|0[0-9].*)$"
    number = text.try_cast(T.DecimalType(38, 10))
    bare = F.when(number == F.floor(number), number.cast(T.DecimalType(38, 0)).cast("string"))
    return F.nullif(F.when(~text.rlike(plain) & text.rlike(dressed), F.coalesce(bare, text)).otherwise(text), F.lit(""))


def compare_text(c: Column, data_type: T.DataType | None = None) -> Column:
    """The text two sides are compared by: stripped, NULL equal to empty."""
    text = c.cast("string") if data_type is None else as_text(c, data_type)
    return strip(F.coalesce(text, F.lit("")))


def row_text(texts: Sequence[Column]) -> Column:
    """One unambiguous text of a whole row: each value after its length.

    A plain separator would let ``("a|", "b")`` equal ``("a", "|b")``.
    """
    return F.concat_ws("", *[F.concat(F.char_length(t).cast("string"), F.lit(":"), t) for t in texts])
