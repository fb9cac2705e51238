"""Samples and reconciliation against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import reconcile, sample


def frame(spark, values, schema="a string, b string"):
    return spark.createDataFrame(values, schema)


def order_of(row):
    return hashlib.sha256("".join(f"{len(v)}:{v}" for v in row).encode()).hexdigest()


@pytest.mark.parametrize("small", [0, 10_000])
@pytest.mark.parametrize("n", [1, 7, 250, 499, 500, 900])
def test_sample_has_exactly_the_first_hashes(spark, n, small):
    values = [(str(i), f"v{i % 5}") for i in range(500)]
    got = sample.hash_sample(frame(spark, values).repartition(3), n, ["a"], small=small).collect()
    expected = sorted(values, key=lambda r: order_of(r[:1]))[:n]
    assert sorted(tuple(r) for r in got) == sorted(expected)


@pytest.mark.parametrize("n", [1, 150, 299, 300, 301, 390])
def test_sample_of_hot_rows(spark, n):
    """One row holds three quarters of the table; the sample takes what it needs of it."""
    values = [("hot", "x")] * 300 + [(str(i), "y") for i in range(100)]
    df = frame(spark, values).repartition(4)
    got = [tuple(r) for r in sample.hash_sample(df, n, small=0).collect()]
    assert len(got) == min(n, 400)
    assert all(got.count(v) <= values.count(v) for v in set(got))
    again = [tuple(r) for r in sample.hash_sample(df.repartition(2), n).collect()]
    assert sorted(got) == sorted(again)


def brute_force(source, target, percentage, count_copies=False):
    wanted = min(len(source), max(1, int(percentage / 100 * min(len(source), len(target)))))
    sampled = sorted(source, key=order_of)[:wanted]
    if count_copies:
        return wanted, sum(min(sampled.count(r), target.count(r)) for r in set(sampled))
    return wanted, sum(r in set(target) for r in sampled)


@pytest.mark.parametrize("percentage", [0.0, 1.0, 10.0, 50.0, 100.0])
@pytest.mark.parametrize("count_copies", [False, True])
def test_content_check_matches_brute_force(spark, percentage, count_copies):
    rng = random.Random(3)
    source = [(str(rng.randrange(60)), rng.choice("xyz")) for _ in range(300)] + [("hot", "hot")] * 150
    target = [r for r in source if rng.random() > 0.2] + [("new", "row")] * 5
    c = reconcile.prepare_comparison(frame(spark, source), frame(spark, target), percentage)
    row = reconcile.content_check(c, "T", count_copies).first()
    assert (row["sample_size"], row["matching_rows"]) == brute_force(source, target, percentage, count_copies)
    found = reconcile.matched_rows(c).agg(F.sum("copies")).first()[0] or 0
    lost = reconcile.mismatched_rows(c).agg(F.sum("copies")).first()[0] or 0
    assert found + lost == row["sample_size"]


def test_normalised_comparison_and_identity(spark):
    source = spark.createDataFrame([(1, " x ", None), (2, "y", "z")], "ID int, a string, b string")
    target = spark.createDataFrame([("1", "x", "", "f"), ("2", "y", " z", "f")], "id string, A string, b string, SOURCE_FILE string")
    row = reconcile.content_check(reconcile.prepare_comparison(source, target, 100.0), "T").first()
    assert (row["status"], row["accuracy_percentage"], row["error_message"]) == ("PASSED", 100.0, None)


def test_row_counts(spark):
    one, two, none = spark.range(10), spark.range(12), spark.range(0)
    message = lambda s, t: reconcile.row_count_check(s, t, "T").first()["error_message"]
    assert message(one, one) is None
    assert message(two, one) == "Missing 2 rows (16.67%)"
    assert message(one, two) == "Surplus 2 rows (20.00%)"
    assert message(none, one) == "Surplus 10 rows (0.00%)"


def test_source_file_filter(spark):
    source = frame(spark, [("1", "a"), ("2", "a")])
    target = spark.createDataFrame([("1", "a", "f1"), ("2", "a", "f1"), ("3", "a", "f2")], "a string, b string, SOURCE_FILE string")
    assert reconcile.row_count_check(source, target, "T", "f1").first()["status"] == "PASSED"
    checks = reconcile.run_checks(source, target, "T", 100.0, source_file="f1").collect()
    assert [r["status"] for r in checks] == ["PASSED", "PASSED"]


def test_nearest_row_report(spark):
    source = spark.createDataFrame([("1", "a", "p"), ("2", "b", "q"), ("3", "c", "r")], "k string, x string, y string")
    target = spark.createDataFrame([("1", "a", "p"), ("2", "b", "CHANGED"), ("9", "c", "r"), ("8", "c", "r")], "k string, x string, y string")
    c = reconcile.prepare_comparison(source, target, 100.0)
    report = reconcile.discrepancy_report(c, columns=None).collect()
    pairs = {(r["column_name"], r["source_value"], r["target_value"]) for r in report}
    assert ("y", "q", "CHANGED") in pairs and ("k", "3", "8") in pairs
    assert {r["matched_columns"] for r in report} == {2}
    order = sorted([("1", "a", "p"), ("2", "b", "q"), ("3", "c", "r")], key=order_of)
    places = {r["row_index"] for r in report}
    assert places == {order.index(("2", "b", "q")) + 1, order.index(("3", "c", "r")) + 1}
    text = reconcile.discrepancy_text(c, limit=60)
    assert text.endswith("... (truncated)") and len(text) == 75


def test_report_text_tells_what_it_leaves_out(spark):
    source = spark.createDataFrame([(str(k), "a", "x" * 60) for k in range(20)], "k string, `x.y` string, z string")
    target = spark.createDataFrame([(str(k), "b" if k < 9 else "a", "x" * 60) for k in range(20)], "k string, `x.y` string, z string")
    c = reconcile.prepare_comparison(source, target, 100.0)
    text = reconcile.discrepancy_text(c)
    assert "... and 4 more rows that differ" in text
    assert "... and 17 more source rows" in text and "... and 17 more target rows" in text
    assert "Column k: 20 values in the source, 20 in the target, 20 in both, 0 in the source only, 0 in the target only." in text
    assert "Column x.y: 1 values in the source, 2 in the target, 1 in both, 0 in the source only, 1 in the target only." in text
    assert f"z='{'x' * 50}...'" in text and not text.endswith("(truncated)")
    cells = reconcile.side_samples(c).collect()
    first = sorted({(str(k), "a", "x" * 60) for k in range(20)}, key=order_of)[:3]
    assert [r["value"] for r in sorted((r for r in cells if r["side"] == "source" and r["column_name"] == "k"), key=lambda r: r["place"])] == [r[0] for r in first]
    few = reconcile.prepare_comparison(source.limit(1), target.limit(1), 100.0)
    assert {(r["side"], r["more_rows"]) for r in reconcile.side_samples(few).collect()} == {("source", 0), ("target", 0)}


def test_checks_never_raise(spark):
    broken = frame(spark, [("1", "a")]).select("a", F.raise_error(F.lit("boom")).cast("string").alias("b"))
    checks = reconcile.run_checks(broken, frame(spark, [("1", "a")]), "T").collect()
    assert checks[-1]["check_type"] == "SYSTEM_ERROR" and "boom" in checks[-1]["error_message"]


def test_column_discrepancies(spark):
    source = frame(spark, [(str(i), "same") for i in range(10)])
    target = frame(spark, [(str(i), "same") for i in range(8, 30)])
    found = {r["column_name"]: r for r in reconcile.column_discrepancies(source, target, ["a", "b"]).collect()}
    a = found["a"]
    assert (a["source_distinct"], a["target_distinct"], a["common_values"], a["source_only"], a["target_only"]) == (10, 22, 2, 8, 20)
    assert a["source_only_examples"] == "0, 1, 2" and a["target_only_examples"] == "10, 11, 12"
    assert found["b"]["source_only_examples"] == ""
