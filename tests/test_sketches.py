"""Sketches of columns: exact when small, within their bound when not, merged over loads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tideline.functions.names import MissingColumns
from tideline.operators.sketches import append_sketches, column_sketches, error_bound, sketch_drift


def drift(spark, path, load, table="T", **more):
    return {r["column_name"]: r for r in sketch_drift(spark, path, table, load, **more).collect()}


def test_small_columns_are_exact(spark, tmp_path):
    path = f"{tmp_path}/s"
    schema = "`a.b` string, n int, v double"
    append_sketches(spark.createDataFrame([("x", 1, 0.5), (" x ", 2, None), (None, 2, None)], schema), path, "T", "2024/01=a")
    append_sketches(spark.createDataFrame([("y", 3, 1.5), ("", 1, 1.5)], schema), path, "T", "007")
    append_sketches(spark.createDataFrame([("other", 9, 9.0)], schema), path, "U", "007")
    got = drift(spark, path, "007")
    of = lambda c: tuple(got[c][k] for k in ("past_distinct", "load_distinct", "common_values", "new_values", "gone_values", "all_distinct"))
    assert of("a.b") == (2, 2, 1, 1, 1, 3) and of("n") == (2, 2, 1, 1, 1, 3) and of("v") == (2, 1, 0, 1, 2, 3)
    assert got["a.b"]["new_share"] == 0.5
    # a load that comes again replaces its own sketches and no other's
    append_sketches(spark.createDataFrame([("x", 1, 0.5)], schema), path, "T", "007")
    assert drift(spark, path, "007")["a.b"]["new_values"] == 0
    assert drift(spark, path, "2024/01=a")["n"]["past_distinct"] == 1
    assert drift(spark, path, "007", table="U")["n"]["past_distinct"] == 0


def test_columns_of_one_side_and_nothing_kept(spark, tmp_path):
    path = f"{tmp_path}/s"
    assert drift(spark, path, "x") == {}
    append_sketches(spark.createDataFrame([(1, 2)], "a int, b int"), path, "T", "one")
    append_sketches(spark.createDataFrame([(1, 2)], "a int, c int"), path, "T", "two", ["A", "c"])
    got = drift(spark, path, "two")
    assert (got["b"]["load_distinct"], got["b"]["gone_values"], got["b"]["new_share"]) == (0, 1, None)
    assert (got["c"]["past_distinct"], got["c"]["new_values"], got["c"]["new_share"]) == (0, 1, 1.0)
    assert column_sketches(spark.createDataFrame([], "a int")).collect() == []
    with pytest.raises(MissingColumns):
        column_sketches(spark.range(1), ["none"])


@pytest.mark.parametrize("parts", [1, 16])
def test_large_columns_stay_within_the_bound(spark, tmp_path, parts):
    path = f"{tmp_path}/s"
    rows = lambda low, high: spark.range(low, high, 1, parts).select(F.col("id").alias("k"), (F.col("id") % 50).alias("few"))
    for name, low, high in (("a", 0, 60_000), ("b", 40_000, 100_000), ("c", 90_000, 120_000)):
        append_sketches(rows(low, high), path, "T", name)
    got = drift(spark, path, "c")
    for name, want in (("past_distinct", 100_000), ("load_distinct", 30_000), ("common_values", 10_000), ("new_values", 20_000), ("gone_values", 90_000), ("all_distinct", 120_000)):
        assert abs(got["k"][name] - want) <= error_bound() * 120_000, name
    assert (got["few"]["past_distinct"], got["few"]["common_values"], got["few"]["new_values"]) == (50, 50, 0)
    files = spark.read.parquet(path).select(F.max(F.length("sketch"))).first()[0]
    assert files <= 8 * 2**12 + 64
