"""Key checks.  Violations come back as rows; they never stop a load."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.names import col, resolve

NULL_KEY, DUPLICATE_KEY, ORPHAN_KEY = "null_key", "duplicate_key", "orphan_key"


def _key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key.  Counts combine before the shuffle, so a hot key is cheap."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n_rows"))


def _any_null(keys: Sequence[str]):
    return reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])


def _all_null(keys: Sequence[str]):
    return reduce(lambda a, b: a & b, [col(k).isNull() for k in keys])


def primary_key_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that are NULL in part or occur more than once: one scan, one shuffle."""
    keys = resolve(columns, df.columns, "primary key columns")
    counts = _key_counts(df, keys)
    return counts.filter(_any_null(keys) | (F.col("n_rows") > 1)).withColumn(
        "violation", F.when(_any_null(keys), F.lit(NULL_KEY)).otherwise(F.lit(DUPLICATE_KEY))
    )


def unique_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; wholly NULL keys do not clash."""
    keys = resolve(columns, df.columns, "index columns")
    counts = _key_counts(df, keys)
    return counts.filter((F.col("n_rows") > 1) & ~_all_null(keys)).withColumn("violation", F.lit(DUPLICATE_KEY))


def foreign_key_violations(
    child: DataFrame, columns: Sequence[str], parent: DataFrame, parent_columns: Sequence[str]
) -> DataFrame:
    """Child keys without a parent row, with their row counts.

    Child keys are counted first, so each distinct key meets the parent once.
    Keys with a NULL part are not checked.
    """
    keys = resolve(columns, child.columns, "foreign key columns")
    parent_keys = resolve(parent_columns, parent.columns, "referenced columns")
    counts = _key_counts(child.filter(~_any_null(keys)), keys)
    aliases = [f"__parent_{i}" for i in range(len(keys))]
    right = parent.select(*[col(p).alias(a) for p, a in zip(parent_keys, aliases)])
    matched = reduce(lambda a, b: a & b, [col(k) == F.col(a) for k, a in zip(keys, aliases)])
    return counts.join(right, matched, "left_anti").withColumn("violation", F.lit(ORPHAN_KEY))


def _common_form(found: DataFrame, kind: str, name: str, keys: Sequence[str]) -> DataFrame:
    return found.select(
        F.lit(kind).alias("constraint_type"),
        F.lit(name).alias("constraint_name"),
        F.to_json(F.struct(*[col(k) for k in keys]), {"ignoreNullFields": "false"}).alias("key_values"),
        F.col("n_rows"),
        F.col("violation"),
    )


def constraint_columns(df: DataFrame, spec: dict) -> None:
    """Fail unless every column the spec's constraints name is there, ignoring case."""
    resolve(spec.get("primary_key") or [], df.columns, "primary key columns")
    for fk in spec.get("foreign_keys") or []:
        resolve(fk.get("columns") or [], df.columns, "foreign key columns")
    for index in spec.get("indexes") or []:
        resolve(index.get("columns") or [], df.columns, "index columns")


def check_constraints(df: DataFrame, spec: dict, parents: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """Violations of every declared key in one frame (None if none is declared).

    Non-unique indexes only describe storage and are not checked.  A foreign key
    is checked if its parent table is among ``parents``.
    """
    parents = {name.upper(): frame for name, frame in (parents or {}).items()}
    frames = []
    if spec.get("primary_key"):
        keys = resolve(spec["primary_key"], df.columns, "primary key columns")
        frames.append(_common_form(primary_key_violations(df, keys), "primary_key", "primary_key", keys))
    for index in spec.get("indexes") or []:
        if index.get("unique") and index.get("columns"):
            keys = resolve(index["columns"], df.columns, "index columns")
            name = index.get("name", "unnamed")
            frames.append(_common_form(unique_violations(df, keys), "unique_index", name, keys))
    for fk in spec.get("foreign_keys") or []:
        table = fk.get("references_table") or fk.get("reference_table")
        target = fk.get("references_columns") or fk.get("reference_columns")
        if not fk.get("columns") or not table or table.upper() not in parents:
            continue
        keys = resolve(fk["columns"], df.columns, "foreign key columns")
        found = foreign_key_violations(df, keys, parents[table.upper()], target)
        frames.append(_common_form(found, "foreign_key", table, keys))
    return reduce(DataFrame.unionByName, frames) if frames else None
