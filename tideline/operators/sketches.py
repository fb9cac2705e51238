"""Distinct values of columns across loads, from sketches kept beside the check history.

A theta sketch keeps the least hashes among a column's distinct values.  Sketches
merge, and two of them tell how many values they share, so what a load brings that
no load before it had is told without reading the old rows again.  A sketch of
``2^size`` hashes takes eight bytes for each; with fewer values than that it is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.names import col, resolve
from tideline.functions.text import compare_text
from tideline.sources.many import path_exists

SIZE = 12  # 4,096 hashes: at most 32 KB for a column and load
DEVIATIONS = 4  # standard errors that the stated bound allows
SKETCH_SCHEMA = "column_name string, n_rows bigint, sketch binary, table_name string, load string"


def error_bound(size: int = SIZE) -> float:
    """Most that a count may be off, as a share of the distinct values of both sides together."""
    return DEVIATIONS / 2 ** (size / 2)


def column_sketches(df: DataFrame, columns: Sequence[str] | None = None, size: int = SIZE) -> DataFrame:
    """``column_name, n_rows, sketch`` for each column, in one pass.

    Values are compared as text, as the exact analysis does: stripped, NULL equal to
    empty.  Each task sends one sketch a column; a table without rows has none.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    names = list(df.columns) if columns is None else resolve(columns, df.columns)
    # A sketch passes over empty strings, so every value begins with a mark.
    marked = lambda n: F.concat(F.lit("="), compare_text(col(n), types[n]))
    cells = [F.struct(F.lit(n).alias("column_name"), marked(n).alias("value")) for n in names]
    return df.select(F.inline(F.array(*cells))).groupBy("column_name").agg(
        F.count("*").alias("n_rows"), F.theta_sketch_agg("value", size).alias("sketch")
    )


def append_sketches(df: DataFrame, path: str, table: str, load: str, columns: Sequence[str] | None = None, size: int = SIZE) -> None:
    """Keep a load's sketches under ``path``; a load that comes again replaces its own."""
    rows = column_sketches(df, columns, size).withColumns({"table_name": F.lit(table), "load": F.lit(load)})
    writer = rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("table_name", "load").parquet(path)


def read_sketches(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``column_name, n_rows, sketch, load`` of a table's loads; none if nothing was kept."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], SKETCH_SCHEMA).drop("table_name")
    return spark.read.schema(SKETCH_SCHEMA).parquet(path).where(F.col("table_name") == table).drop("table_name")


def _estimate(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("bigint")


def sketch_counts(old: DataFrame, new: DataFrame, size: int = SIZE) -> DataFrame:
    """Distinct, common and one-sided values of each column of two sides ``(column_name, sketch)``."""
    sides = (side.select("column_name", F.col("sketch").alias(name)) for side, name in ((old, "old"), (new, "new")))
    both = next(sides).join(next(sides), "column_name", "full")
    o, n = F.col("old"), F.col("new")
    everything = F.when(o.isNull(), n).when(n.isNull(), o).otherwise(F.theta_union(o, n, size))
    return both.select(
        "column_name",
        _estimate(o).alias("past_distinct"),
        _estimate(n).alias("load_distinct"),
        _estimate(F.theta_intersection(o, n)).alias("common_values"),
        _estimate(F.when(o.isNull(), n).otherwise(F.theta_difference(n, o))).alias("new_values"),
        _estimate(F.when(n.isNull(), o).otherwise(F.theta_difference(o, n))).alias("gone_values"),
        _estimate(everything).alias("all_distinct"),
    )


def sketch_drift(spark: SparkSession, path: str, table: str, load: str, size: int = SIZE) -> DataFrame:
    """How a load's columns differ from all other loads of its table, one row a column.

    ``past_distinct`` and ``load_distinct`` are distinct values of the other loads and
    of this one, ``common_values`` those in both, ``new_values`` those of this load only,
    ``gone_values`` those it lacks, ``all_distinct`` all together, and ``new_share`` the new
    ones among the load's.  Each count is off by at most ``error_bound(size)`` times
    ``all_distinct``, save for a chance of about one in 16,000.  Columns that only one
    side has count as empty on the other.
    """
    kept = read_sketches(spark, path, table).select("column_name", "n_rows", "sketch", (F.col("load") == load).alias("own"))
    merged = kept.groupBy("column_name", "own").agg(F.theta_union_agg("sketch", size).alias("sketch"))
    old, new = (merged.where(side).select("column_name", "sketch") for side in ("NOT own", "own"))
    counts = sketch_counts(old, new, size)
    share = F.when(F.col("load_distinct") > 0, F.least(F.col("new_values") / F.col("load_distinct"), F.lit(1.0)))
    return counts.withColumn("new_share", share)
