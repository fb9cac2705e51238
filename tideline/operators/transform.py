"""Cleaning steps and their fixed-order chain."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.names import clean_headers, col, resolve, trim_headers
from tideline.functions.text import nested_to_text, trim_strings

NULL_STRATEGIES = ("keep", "drop_rows", "fill_default")


def fill_nulls(df: DataFrame) -> DataFrame:
    """Type defaults for NULL: 0, 0.0, empty text, false; other types keep NULL."""
    defaults: dict[str, object] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            defaults[f.name] = F.lit("")
        elif isinstance(f.dataType, T.BooleanType):
            defaults[f.name] = F.lit(False)
        elif isinstance(f.dataType, (T.IntegralType, T.FractionalType)) and not isinstance(f.dataType, T.DecimalType):
            defaults[f.name] = F.lit(0).cast(f.dataType)
    return df.withColumns({n: F.coalesce(col(n), d) for n, d in defaults.items()}) if defaults else df


def handle_nulls(df: DataFrame, strategy: str = "keep") -> DataFrame:
    if strategy == "keep":
        return df
    if strategy == "drop_rows":
        # F.isnull only: NaN is a value here, which na.drop() would also remove.
        for name in df.columns:
            df = df.filter(col(name).isNotNull())
        return df
    if strategy == "fill_default":
        return fill_nulls(df)
    raise ValueError(f"unknown null strategy {strategy!r}, expected one of {NULL_STRATEGIES}")


def _step(c: Column, operation: str, params: dict) -> Column:
    if operation == "upper":
        return F.upper(c)
    if operation == "lower":
        return F.lower(c)
    if operation == "replace":
        return F.regexp_replace(c, F.lit(params.get("old", "")), F.lit(params.get("new", "")))
    if operation == "cast":
        return c.try_cast(params.get("type", "string"))
    warnings.warn(f"unknown column operation {operation!r} leaves its column as it is", stacklevel=3)
    return c


def apply_operations(df: DataFrame, operations: Sequence[dict]) -> DataFrame:
    """Apply ``{column, operation, params}`` steps as one projection.

    Steps on the same column compose in the order given.
    """
    exprs: dict[str, Column] = {}
    for op in operations:
        name = op["column"]
        if name not in df.columns:
            warnings.warn(f"column {name!r} is not in the data, its operation is skipped", stacklevel=2)
            continue
        exprs[name] = _step(exprs.get(name, col(name)), op["operation"], op.get("params") or {})
    return df.withColumns(exprs) if exprs else df


def dedupe(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Distinct rows, or one row per key.

    Without an order the survivor of a key is arbitrary.  With one it is the
    first row, and Spark keeps only each map task's first row per key before the
    shuffle, so a key that owns a third of the table does not reach one task.
    """
    if not subset:
        return df.distinct()
    keys = resolve(subset, df.columns, "dedupe columns")
    if not order_by:
        return df.dropDuplicates(keys)
    window = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order_by)
    rank = "__rank"
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


@dataclass
class CleaningOptions:
    """Switches of the chain, all with the usual defaults."""

    fix_types: bool = True
    null_strategy: str = "keep"
    trim: bool = True
    operations: Sequence[dict] = field(default_factory=tuple)
    remove_duplicates: bool = False
    dedupe_subset: Sequence[str] | None = None
    dedupe_order: Sequence[Column] | None = None
    clean_names: bool = True


def clean_table(df: DataFrame, options: CleaningOptions | None = None) -> tuple[DataFrame, dict[str, str]]:
    """types -> nulls -> trim -> operations -> dedupe -> names, lazily.

    Returns the frame and the raw -> final name map (identity if names are kept).
    """
    o = options or CleaningOptions()
    raw = df.columns
    if o.fix_types:
        df = nested_to_text(df)
    df = handle_nulls(df, o.null_strategy)
    if o.trim:
        df = trim_strings(df)
    df = apply_operations(df, o.operations)
    if o.remove_duplicates:
        df = dedupe(df, o.dedupe_subset, o.dedupe_order)
    if o.clean_names:
        df, _ = clean_headers(trim_headers(df))
    return df, dict(zip(raw, df.columns))
