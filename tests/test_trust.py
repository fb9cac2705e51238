"""Versions through crashes, conflicts and rollbacks; differences against counting; runs that keep the old table."""

from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tideline.operators import hash_tree
from tideline.operators.hash_tree import comparable, differing_buckets, read_tree, table_differences, tree_of, write_tree
from tideline.operators.transform import CleaningOptions
from tideline.plans.run import run_table, run_tables
from tideline.sinks import versions


def numbers(spark, path, **which):
    return sorted(r["id"] for r in versions.read_version(spark, path, **which).collect())


def test_versions_follow_their_manifests(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert versions.current(spark, path) is None and not versions.is_versioned(spark, path)
    with pytest.raises(FileNotFoundError):
        versions.read_version(spark, path)
    first = versions.replace_table(spark.range(3), path)
    assert (first.number, first.rows) == (1, 3) and numbers(spark, path) == [0, 1, 2]
    staged = versions.stage_version(spark.range(5, 7), path)
    assert numbers(spark, path) == [0, 1, 2]
    versions.commit(spark, path, staged, 1)
    assert numbers(spark, path) == [5, 6] and numbers(spark, path, number=1) == [0, 1, 2]
    # a writer that looked before the other one wrote
    late = versions.stage_version(spark.range(1), path)
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, path, late, 1)
    assert versions.rollback(spark, path).number == 3 and numbers(spark, path) == [0, 1, 2]
    assert versions.rollback(spark, path, to=2).number == 4 and numbers(spark, path) == [5, 6]
    assert [v.number for v in versions.history(spark, path)] == [4, 3, 2, 1]
    # the table's own path is no table by mistake
    with pytest.raises(Exception, match="(?i)schema"):
        spark.read.parquet(path)


def test_a_manifest_cut_short_is_none(spark, tmp_path):
    path = f"{tmp_path}/t"
    versions.replace_table(spark.range(3), path)
    with open(f"{path}/_manifests/0000000002.json", "w") as f:
        f.write('{"folder": "abc", "for')
    assert numbers(spark, path) == [0, 1, 2] and versions.newest(spark, path) == 2
    assert versions.replace_table(spark.range(1), path).number == 3
    assert numbers(spark, path) == [0]


def test_vacuum_keeps_what_is_named_or_young(spark, tmp_path):
    path = f"{tmp_path}/t"
    for n in range(1, 5):
        versions.replace_table(spark.range(n), path)
    versions.stage_version(spark.range(9), path)
    assert len(versions.vacuum(spark, path, keep=2)) == 2
    assert [v.number for v in versions.history(spark, path)] == [4, 3]
    assert len(os.listdir(f"{path}/_versions")) == 3  # the staged one is young
    assert len(versions.vacuum(spark, path, keep=1, unnamed_for=0)) == 2
    assert numbers(spark, path) == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        versions.vacuum(spark, path, keep=0)


def test_a_run_whose_checks_fail_keeps_the_old_table(spark, tmp_path, monkeypatch):
    spec = {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "versioned": True, "data_quality_checks": {"sample_percentage": 100}}
    spark.range(4).write.parquet(f"{tmp_path}/in")
    assert run_table(spark, spec, str(tmp_path), str(tmp_path)).loaded
    spark.range(9).write.mode("overwrite").parquet(f"{tmp_path}/in")
    whole = versions.stage_version
    monkeypatch.setattr(versions, "stage_version", lambda df, *a, **k: whole(df.where("id <> 5"), *a, **k))
    (run,) = run_tables(spark, {"t": spec}, str(tmp_path), str(tmp_path))
    assert (run.loaded, run.failed_stage, run.quality_passed) == (False, "check", False) and "stays as it was" in run.error
    assert versions.read_version(spark, f"{tmp_path}/T").count() == 4
    assert len(os.listdir(f"{tmp_path}/T/_versions")) == 1
    monkeypatch.undo()
    assert run_tables(spark, {"t": spec}, str(tmp_path), str(tmp_path))[0].loaded
    assert versions.read_version(spark, f"{tmp_path}/T").count() == 9


def test_a_parent_that_failed_is_not_taken_from_an_earlier_run(spark, tmp_path):
    spark.createDataFrame([("1",), ("2",)], "k string").write.parquet(f"{tmp_path}/PARENT")
    spark.createDataFrame([("1",), ("7",)], "k string").write.parquet(f"{tmp_path}/c")
    key = {"columns": ["k"], "references_table": "PARENT", "references_columns": ["k"]}
    child = {"source_type": "parquet", "source_file_path": "c", "target_table": "CHILD", "foreign_keys": [key]}
    for target in ("parquet", "csv"):
        parent = {"source_type": "parquet", "source_file_path": "missing", "target_table": "PARENT", "target_type": target}
        failed, run = run_tables(spark, {"p": parent, "c": child}, str(tmp_path), str(tmp_path))
        assert failed.failed_stage == "extract" and run.key_error is None and run.unchecked_keys == ["PARENT"]
    assert run_tables(spark, {"c": child}, str(tmp_path), str(tmp_path))[0].violations == 1


def test_a_versioned_parent_is_followed(spark, tmp_path):
    versions.replace_table(spark.createDataFrame([("1",)], "k string"), f"{tmp_path}/PARENT")
    versions.replace_table(spark.createDataFrame([("1",), ("7",)], "k string"), f"{tmp_path}/PARENT")
    spark.createDataFrame([("1",), ("7",), ("8",)], "k string").write.parquet(f"{tmp_path}/c")
    key = {"columns": ["k"], "references_table": "PARENT", "references_columns": ["k"]}
    run = run_table(spark, {"source_type": "parquet", "source_file_path": "c", "target_table": "CHILD", "foreign_keys": [key]}, str(tmp_path), str(tmp_path))
    assert run.violations == 1


@pytest.mark.parametrize("target", ["parquet", "csv", "dbf"])
def test_steps_that_leave_nothing(spark, tmp_path, target):
    spark.createDataFrame([("1", None), ("2", None)], "k string, v string").write.parquet(f"{tmp_path}/in")
    spec = {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "target_type": target}
    cleaning = CleaningOptions(null_strategy="drop_rows")
    for extra in ({}, {"column_types": {"k": "integer"}}):
        run = run_table(spark, {**spec, **extra}, str(tmp_path), str(tmp_path), cleaning=cleaning)
        assert (run.loaded, run.quality_passed, run.total_rows) == (True, True, 0)


def tables(seed, n=400):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 200), rng.choice(["a", " a", None, ""]), rng.choice([1.5, 2.0])) for _ in range(n)]
    other = [r for r in rows if rng.random() > 0.02] + rng.choices(rows, k=5) + [(999, "new", 1.5)]
    return rows, other


@pytest.mark.parametrize("digits", [2, 4])
@pytest.mark.parametrize("few", [0, 200_000])
def test_differences_equal_counting(spark, digits, few, monkeypatch):
    monkeypatch.setattr(hash_tree, "BROADCAST_BUCKETS", few)
    rows, other = tables(1)
    schema = "k int, t string, v double"
    source, target = spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema).selectExpr("v AS V", "t", "k", "1 AS U_ID").repartition(7)
    text = lambda r: (str(r[0]), (r[1] or "").strip(), str(r[2]))
    a, b = Counter(map(text, rows)), Counter(map(text, other))
    want = sorted((*r, a[r], b[r]) for r in a | b if a[r] != b[r])
    got = table_differences(source, target, digits=digits)
    assert got.columns == ["k", "t", "v", "source_copies", "target_copies"]
    assert sorted(map(tuple, got.collect())) == want and len(want) > 5


def test_only_differing_buckets_are_found(spark, tmp_path):
    df = spark.range(5000).withColumn("x", F.col("id") * 3)
    pairs = [("id", "id"), ("x", "x")]
    one, two = comparable(df, pairs), comparable(df.withColumn("x", F.when(F.col("id") == 77, 0).otherwise(F.col("x"))).repartition(5), pairs)
    trees = tree_of(one), tree_of(two)
    assert differing_buckets(*trees).count() == 2  # where the row was, and where it is now
    assert differing_buckets(trees[0], trees[0]).count() == 0
    root = {r["level"]: r["n"] for r in trees[0].groupBy("level").agg(F.sum("n").alias("n")).collect()}
    assert root == {0: 5000, 1: 5000, 2: 5000}
    write_tree(one, f"{tmp_path}/tree")
    kept = read_tree(spark, f"{tmp_path}/tree")
    assert table_differences(df, df.where("id <> 5"), source_tree=kept).collect()[0]["id"] == "5"
    assert table_differences(df, df, source_tree=kept, target_tree=kept).isEmpty()


def test_empty_sides(spark):
    df = spark.range(3)
    assert table_differences(df, df.limit(0)).count() == 3
    assert table_differences(df.limit(0), df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        table_differences(df, df.withColumnRenamed("id", "other"))
