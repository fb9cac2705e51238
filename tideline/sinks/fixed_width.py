"""Fixed-width targets: text lines or dBASE tables, from one field list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.convert import full_text
from tideline.functions.names import col
from tideline.functions.text import strip
from tideline.operators.profile import field_spec
from tideline.sinks.tables import MODES
from tideline.sources.fixed_width import Field, fields_from_spec, single_byte
from tideline.sources.many import path_exists


def unpadded(c: Column, data_type: T.DataType, field: Field) -> Column:
    """A field's text before padding; NULL becomes empty."""
    if field.kind == "D":
        text = F.date_format(c.try_cast("timestamp"), "yyyyMMdd")
    elif field.kind == "L":
        text = F.when(c.try_cast("boolean"), F.lit("T")).when(~c.try_cast("boolean"), F.lit("F"))
    elif field.kind in "NF":
        text = c.try_cast(T.DecimalType(38, field.decimals)).cast("string")
    else:
        text = full_text(c, data_type)
    return F.coalesce(text, F.lit(""))


def padded(text: Column, field: Field) -> Column:
    """Numbers to the right, everything else to the left."""
    fill = F.lpad if field.kind in "NF" else F.rpad
    return fill(text, field.length, " ")


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def _cells(df: DataFrame, fields: Sequence[Field]) -> list[Column]:
    types = _types(df)
    return [padded(unpadded(col(f.name), types[f.name], f), f) for f in fields]


def record_text(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """One line per row."""
    return df.select(F.concat(*_cells(df, fields)).alias("value"))


def overflows(df: DataFrame, fields: Sequence[Field]) -> DataFrame:
    """Values that do not fit their field, which a plain write would cut."""
    types = _types(df)
    cells = F.array(
        *[
            F.struct(F.lit(f.name).alias("field_name"), unpadded(col(f.name), types[f.name], f).alias("value"), F.lit(f.length).alias("length"))
            for f in fields
        ]
    )
    return df.select(F.inline(cells)).filter(F.char_length("value") > F.col("length"))


def misfits(df: DataFrame, fields: Sequence[Field], encoding: str | None = None) -> Column:
    """Names of a row's fields whose value does not fit; empty if all do.

    Widths are characters; of a codepage with several bytes for a character, bytes.
    """
    types = _types(df)
    reasons = []
    for f in fields:
        text = unpadded(col(f.name), types[f.name], f)
        size = F.char_length(text) if encoding is None or single_byte(encoding) else F.octet_length(F.encode(text, encoding))
        given = col(f.name).try_cast("string").isNotNull()
        lost = given & (text == "") & (strip(col(f.name).try_cast("string")) != "") if f.kind != "C" else F.lit(False)
        rounded = F.lit(False)
        if f.kind in "NF":
            exact = col(f.name).try_cast(T.DecimalType(38, 18))
            rounded = F.coalesce(exact != text.try_cast(T.DecimalType(38, 18)), F.lit(False))
        reasons.append(F.when((size > f.length) | lost | rounded, F.lit(f"{f.name}:does_not_fit")))
    return F.concat_ws(";", *reasons)


def fitted_fields(df: DataFrame, fields: Sequence[Field]) -> list[Field]:
    """The fields with numbers as wide, and with as many decimals, as the data needs (one pass)."""
    types = _types(df)
    numbers = [f for f in fields if f.kind in "NF"]
    if not numbers:
        return list(fields)
    sizes = []
    for k, f in enumerate(numbers):
        exact = col(f.name).try_cast(T.DecimalType(38, 18))
        tail = F.regexp_extract(exact.cast("string"), r"\.([0-9]*?)0*$", 1)
        integral = isinstance(types[f.name], T.IntegralType)
        sizes += [F.max(F.length(F.lit("") if integral else tail)).alias(f"d{k}"), F.max(F.length(F.regexp_extract(exact.cast("string"), r"^-?[0-9]+", 0))).alias(f"w{k}")]
    row = df.agg(*sizes).first()
    wider = {}
    for k, f in enumerate(numbers):
        decimals = max(f.decimals, row[f"d{k}"] or 0)
        wider[f.name] = Field(f.name, f.kind, max(f.length, (row[f"w{k}"] or 0) + (decimals + 1 if decimals else 0)), decimals)
    return [wider.get(f.name, f) for f in fields]


def short_names(names: Sequence[str], limit: int = 10) -> dict[str, str]:
    """Each name as a field name of at most ``limit`` ASCII characters, no two alike."""
    taken: set[str] = set()
    out = {}
    for name in names:
        plain = "".join(c if c.isascii() and c.isprintable() and c not in ":;" else "_" for c in name)
        short, n = plain[:limit], 0
        while short.upper() in taken:
            n += 1
            short = plain[: limit - len(str(n))] + str(n)
        taken.add(short.upper())
        out[name] = short
    return out


def _whole(df: DataFrame, fields: Sequence[Field], on_overflow: str, encoding: str | None = None) -> DataFrame:
    """``refuse`` stops the write at the first value that would be cut; ``cut`` cuts it."""
    if on_overflow == "cut":
        return df
    if on_overflow != "refuse":
        raise ValueError("on_overflow must be 'refuse' or 'cut'")
    bad = misfits(df, fields, encoding)
    return df.filter(F.when(bad == "", F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("value too wide for its field: "), bad)).cast("boolean")))


def write_fixed_text(
    df: DataFrame, path: str, fields: Sequence[Field] | None = None, mode: str = "replace", on_overflow: str = "refuse"
) -> list[Field]:
    """Lines of text.  Without a field list the widths come from the data."""
    fields = list(fields or fields_from_spec(field_spec(df)))
    df = _whole(df, fields, on_overflow)
    record_text(df, fields).write.mode(MODES[mode]).text(path)
    return fields


def write_dbf(
    df: DataFrame,
    path: str,
    fields: Sequence[Field] | None = None,
    mode: str = "replace",
    encoding: str = "windows-1252",
    on_overflow: str = "refuse",
) -> list[Field]:
    """A folder of dBASE tables, one per partition; the fields as the data's columns name them.

    The tables' own field names (ten ASCII characters) are ``short_names`` of these.

    Values are padded and encoded by Spark; tasks only put the header in front.
    Text is padded in bytes, so multi-byte codepages keep the record length.
    """
    from tideline.sources.dbf_format import register

    if mode == "fail":
        if path_exists(df.sparkSession, path):
            raise FileExistsError(f"[PATH_ALREADY_EXISTS] {path}")
        mode = "append"
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown write mode {mode!r}, expected one of {tuple(MODES)}")
    fields = list(fields or fields_from_spec(field_spec(df)))
    df = _whole(df, fields, on_overflow, encoding)
    names = short_names([f.name for f in fields])
    register(df.sparkSession)
    if single_byte(encoding):
        record = F.encode(F.concat(F.lit(" "), *_cells(df, fields)), encoding)
    else:
        encoded = [F.encode(c, encoding) for c in _cells(df, fields)]
        blank = F.lit(bytearray(b" "))
        fitted = [F.rpad(F.substring(data, 1, f.length), f.length, blank) for data, f in zip(encoded, fields)]
        record = F.concat(blank, *fitted)
    described = ";".join(f"{names[f.name]}:{f.kind}:{f.length}:{f.decimals}" for f in fields)
    (
        df.select(record.alias("record")).write.format("dbf_records")
        .mode(MODES[mode]).option("fields", described).save(path)
    )
    return fields
