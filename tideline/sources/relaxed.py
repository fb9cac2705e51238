"""Typed tables whose columns have different types, under the least type that holds all of them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.names import col
from tideline.functions.text import as_text
from tideline.operators.rejects import REASONS, SOURCE_ROW
from tideline.sources.many import typed_groups
from tideline.sources.typed import read_typed
from tideline.sources.union import LINEAGE, with_source_file

# Decimal digits that hold every value of a whole-number type, smallest type first.
WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
FLOATING = (T.FloatType, T.DoubleType)
MOST_DIGITS = 38


class LossyUnion(ValueError):
    """Values that the common type of their column does not hold."""


def common_type(types: Iterable[T.DataType]) -> T.DataType:
    """The least type that holds all types, whatever their order.

    Whole numbers widen; with decimals they become a decimal wide enough for both sides of
    the point; with floating numbers all become double.  Booleans beside whole numbers
    are 0 and 1.  Dates beside timestamps are timestamps.  What has nothing in
    common, or would need more than 38 digits, is text.
    """
    distinct = {t.simpleString(): t for t in types if not isinstance(t, T.NullType)}
    kinds = list(distinct.values())
    if not kinds:
        return T.NullType()
    if len(kinds) == 1:
        return kinds[0]
    numbers = [t for t in kinds if isinstance(t, (*WHOLE, *FLOATING, T.DecimalType))]
    if len(numbers) == len(kinds):
        if any(isinstance(t, FLOATING) for t in kinds):
            return T.DoubleType()
        decimals = [t for t in kinds if isinstance(t, T.DecimalType)]
        if not decimals:
            return max(kinds, key=lambda t: WHOLE[type(t)])
        scale = max(t.scale for t in decimals)
        whole = max([t.precision - t.scale for t in decimals] + [WHOLE[type(t)] for t in kinds if type(t) in WHOLE])
        return T.DecimalType(whole + scale, scale) if whole + scale <= MOST_DIGITS else T.StringType()
    if all(isinstance(t, (T.BooleanType, *WHOLE)) for t in kinds):
        return max(numbers, key=lambda t: WHOLE[type(t)])
    if all(isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)) for t in kinds):
        return T.TimestampType() if T.TimestampType() in kinds else T.TimestampNTZType()
    return T.StringType()


def _converted(c: Column, given: T.DataType, wanted: T.DataType) -> Column:
    if given == wanted:
        return c
    return as_text(c, given) if isinstance(wanted, T.StringType) else c.cast(wanted)


def _loses(c: Column, given: T.DataType, wanted: T.DataType) -> Column | None:
    """Whether a value would not come back as it was; None where no value can be lost."""
    if not isinstance(wanted, T.DoubleType) or isinstance(given, (*FLOATING, T.NullType, T.ByteType, T.ShortType, T.IntegerType)):
        return None
    return c.isNotNull() & ~c.eqNullSafe(c.cast(wanted).try_cast(given))


def union_relaxed(frames: Sequence[DataFrame], on_loss: str = "refuse") -> DataFrame:
    """All rows of all frames; columns meet by name, ignoring case, in their common type.

    Columns a frame lacks are NULL.  Only a long or a decimal that becomes a double can lose digits.  ``on_loss``:
    ``refuse`` counts such values and raises ``LossyUnion`` if there are any, ``reject`` adds
    the reject columns, so that ``good_rows`` and ``rejected_rows`` part them, and ``keep`` takes the nearest double.
    """
    if on_loss not in ("refuse", "reject", "keep"):
        raise ValueError("on_loss must be 'refuse', 'reject' or 'keep'")
    names: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}
    for f in (f for df in frames for f in df.schema.fields):
        names.setdefault(f.name.lower(), f.name)
        types.setdefault(f.name.lower(), []).append(f.dataType)
    wanted = {key: common_type(kinds) for key, kinds in types.items()}
    parts, lossy = [], []
    for df in frames:
        own = {f.name.lower(): f for f in df.schema.fields}
        cells, reasons = [], []
        for key, name in names.items():
            f = own.get(key)
            cells.append((F.lit(None).cast(wanted[key]) if f is None else _converted(col(f.name), f.dataType, wanted[key])).alias(name))
            lost = None if f is None else _loses(col(f.name), f.dataType, wanted[key])
            if lost is not None:
                reasons.append(F.when(lost, F.lit(f"{name}:not_{wanted[key].typeName()}")))
        if on_loss == "reject":
            original = F.to_json(F.struct(*[col(c) for c in df.columns]), {"ignoreNullFields": "false"})
            why = F.concat_ws(";", *reasons) if reasons else F.lit("")
            cells += [why.alias(REASONS), F.when(why != "", original).alias(SOURCE_ROW)]
        elif reasons:
            lossy.append(df.select(F.explode(F.array(*reasons)).alias("why")).where("why IS NOT NULL"))
        parts.append(df.select(*cells))
    if lossy and on_loss == "refuse":
        found = reduce(DataFrame.unionAll, lossy).groupBy("why").count().orderBy("why").collect()
        if found:
            raise LossyUnion("; ".join(f"{r['why']}: {r['count']} values" for r in found))
    out = reduce(DataFrame.unionAll, parts)
    last = [c for c in (LINEAGE, REASONS, SOURCE_ROW) if c in out.columns]
    return out.select(*[col(c) for c in out.columns if c not in last], *last)


def read_relaxed_files(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", on_loss: str = "refuse") -> DataFrame:
    """Typed files whose columns and types may differ, with their types and their path; like schemas share one scan."""
    frames = [with_source_file(read_typed(spark, group, fmt), LINEAGE) for group in typed_groups(spark, paths, fmt)]
    return union_relaxed(frames, on_loss)
