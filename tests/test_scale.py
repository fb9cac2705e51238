"""The plans large inputs depend on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tideline.operators import constraints, datetimes, profile, reconcile, transform
from tideline.suite.registry import table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lines(spark):
    return table(spark, FOLDER, "lineitem")


def test_keys_are_counted_before_the_only_shuffle(lines):
    text = plan(constraints.primary_key_violations(lines, ["l_orderkey", "l_linenumber"]))
    assert text.count("Exchange") == 1 and "partial_count" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in text


def test_dedupe_limits_each_key_before_the_shuffle(lines):
    text = plan(transform.dedupe(lines, ["l_orderkey"], [F.col("l_shipdate")]))
    assert "row_number(), 1, Partial" in text and text.count("Exchange") == 1


def test_profiles_send_one_row_per_column(lines):
    for df in (profile.width_profile(lines), profile.field_spec(lines), datetimes.datetime_profile(lines.selectExpr("cast(l_shipdate as string) d"))):
        text = plan(df)
        assert "partial_" in text and "SortMergeJoin" not in text and "Cartesian" not in text


def test_file_filter_reaches_the_scan(spark, tmp_path):
    spark.range(10).withColumn("SOURCE_FILE", F.lit("a")).write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    text = plan(reconcile.row_count_check(spark.range(1), target, "T", "a"))
    assert "EqualTo(SOURCE_FILE,a)" in text and "ReadSchema: struct<SOURCE_FILE:string>" in text


def test_match_shuffles_hashes_only(spark, lines):
    c = reconcile.prepare_comparison(lines, lines, 10.0)
    assert [f.name for f in c.matches.schema.fields] == ["__order", "s", "t"]
    # rows beyond the sample's reach are one group
    assert c.matches.count() < 0.15 * c.source_count


@pytest.mark.parametrize("build", ["nearest", "columns", "content"])
def test_no_cross_joins(spark, build):
    source = spark.createDataFrame([(str(i), "a") for i in range(50)], "k string, x string")
    target = source.withColumn("x", F.lit("b"))
    c = reconcile.prepare_comparison(source, target, 50.0)
    df = {
        "nearest": lambda: reconcile.discrepancy_report(c),
        "columns": lambda: reconcile.column_discrepancies(source, target, ["k", "x"]),
        "content": lambda: reconcile.content_check(c, "T"),
    }[build]()
    assert "NestedLoopJoin" not in plan(df) and "CartesianProduct" not in plan(df)


def test_results_do_not_depend_on_partitioning(spark):
    orders = table(spark, FOLDER, "orders").selectExpr("cast(o_orderkey as string) k", "o_orderstatus s")
    changed = orders.withColumn("s", F.when(F.col("k").cast("int") % 7 == 0, F.lit("?")).otherwise(F.col("s")))
    seen = set()
    for parts in (1, 5, 16):
        c = reconcile.prepare_comparison(orders.repartition(parts), changed.repartition(parts), 10.0)
        rows = sorted(tuple(r) for r in reconcile.mismatched_rows(c).collect())
        seen.add((tuple(rows), reconcile.content_check(c, "T").first()["matching_rows"]))
    assert len(seen) == 1


def test_large_parents_meet_counted_keys(spark, lines):
    """Without a broadcast the child's rows must be counted before they are shuffled."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(constraints.foreign_key_violations(lines, ["l_orderkey"], table(spark, FOLDER, "orders"), ["o_orderkey"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "LeftAnti" in text and text.count("Exchange") == 2
    assert text.index("LeftAnti") < text.index("HashAggregate")


def test_discrepancies_compute_distinct_values_once(spark, lines):
    df = reconcile.column_discrepancies(lines, lines.filter("l_tax > 0.01"), ["l_quantity", "l_tax"])
    rows = df._jdf.queryExecution()
    df._jdf.collectToPython()
    assert "ReusedExchange" in rows.executedPlan().toString()
