"""Cleaning, detection, profiles, keys, rejects on small frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tideline.operators import constraints, datetimes, profile, rejects, transform


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


DATES = [
    (1, "2025-07-03 17:56:23.001", "7/3/2025", "2025-07-03", "20250703", "x", None, "03/07/2025"),
    (2, "2025-07-04 00:00:00", "12/31/2025", "2025-13-01", "20250704", "y", None, "25/07/2025"),
    (3, None, "junk", "2025-07-05", None, "z", None, None),
]
DATE_NAMES = "id int, created_at string, shipped string, due_date string, ship_date string, candidate string, updated string, european string"


def test_datetime_detection(spark):
    df = spark.createDataFrame(DATES, DATE_NAMES)
    found = {r["column_name"]: r for r in datetimes.datetime_profile(df).collect()}
    assert {n: r["pattern"] for n, r in found.items()} == {
        "created_at": "iso_fraction", "shipped": "month_first_date", "due_date": "iso_date", "ship_date": "compact_date",
        "candidate": None, "updated": None, "european": "month_first_date",
    }
    assert (found["shipped"]["flagged_by_name"], found["shipped"]["flagged_by_content"]) == (False, True)
    assert found["due_date"]["unparsed_count"] == 1 and found["european"]["unparsed_count"] == 1


def test_datetime_rewrite_null_keep_and_typed(spark):
    df = spark.createDataFrame(DATES, DATE_NAMES)
    gone = rows(datetimes.normalize_datetimes(df).select("id", "created_at", "shipped", "due_date", "candidate"), "id")
    assert gone == [
        (1, "07/03/2025 05:56 PM", "07/03/2025", "07/03/2025", "x"),
        (2, "07/04/2025 12:00 AM", "12/31/2025", None, "y"),
        (3, None, None, "07/05/2025", "z"),
    ]
    kept = datetimes.normalize_datetimes(df, on_unparsed="keep", keep_typed=True)
    assert rows(kept.select("id", "shipped"), "id")[2] == (3, "junk")
    assert "created_at__ts" in kept.columns
    assert kept.select("created_at__ts").filter("id = 1").first()[0].second == 23


def test_detection_does_not_depend_on_row_order(spark):
    df = spark.createDataFrame([(i, "plain") for i in range(50)] + [(50, "2025-01-02")], "id int, c string")
    for parts in (1, 7):
        found = datetimes.datetime_profile(df.repartition(parts)).first()
        assert (found["pattern"], found["parsed_count"]) == ("iso_date", 1)


def test_wide_table_detection(spark):
    names = [f"c{i}" for i in range(300)]
    df = spark.createDataFrame([tuple("2025-01-02" if i % 2 else "a" for i in range(300))], ", ".join(f"{n} string" for n in names))
    assert len(datetimes.choose_patterns(df)) == 150


def test_null_strategies(spark):
    df = spark.createDataFrame([(1, None, None, None, None), (2, 1.5, "x", True, 7)], "a int, b double, c string, d boolean, e smallint")
    assert rows(transform.handle_nulls(df, "drop_rows")) == [(2, 1.5, "x", True, 7)]
    assert rows(transform.handle_nulls(df, "fill_default")) == [(1, 0.0, "", False, 0), (2, 1.5, "x", True, 7)]
    assert transform.handle_nulls(df, "fill_default").schema["e"].dataType.simpleString() == "smallint"
    with pytest.raises(ValueError):
        transform.handle_nulls(df, "guess")


def test_drop_rows_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,)], "a double")
    assert transform.handle_nulls(df, "drop_rows").count() == 1


def test_operations_compose_and_warn(spark):
    df = spark.createDataFrame([("Ab1", "7x")], "a string, b string")
    with pytest.warns(UserWarning):
        out = transform.apply_operations(
            df,
            [
                {"column": "a", "operation": "replace", "params": {"old": "([0-9])", "new": "<$1>"}},
                {"column": "a", "operation": "upper"},
                {"column": "zz", "operation": "upper"},
                {"column": "b", "operation": "cast", "params": {"type": "int"}},
                {"column": "b", "operation": "twist"},
            ],
        )
    assert rows(out) == [("AB<1>", None)]


def test_dedupe_is_deterministic_with_an_order(spark):
    df = spark.createDataFrame([(k % 3, v) for k, v in zip(range(30), range(30))], "k int, v int")
    for parts in (1, 8):
        out = transform.dedupe(df.repartition(parts), ["K"], [F.col("v").desc()])
        assert rows(out) == [(0, 27), (1, 28), (2, 29)]


def test_clean_table_order_and_mapping(spark):
    df = spark.createDataFrame([(" a ", [1, 2]), ("a", [1, 2])], "`first name ` string, `list` array<int>")
    out, mapping = transform.clean_table(df, transform.CleaningOptions(remove_duplicates=True))
    assert mapping == {"first name ": "first_name", "list": "list"}
    assert rows(out) == [("a", "[1,2]")]


@pytest.mark.parametrize("length, width", [(None, 255), (10, 1000), (833, 1000), (835, 1002), (900, 1080), (5000, 4000)])
def test_widths(spark, length, width):
    df = spark.createDataFrame([(None if length is None else "x" * length,)], "c string")
    r = profile.width_profile(df).first()
    assert (r["max_length"], r["recommended_width"], r["declared_width"]) == (length, width, max(width, 1000))


def test_type_profile_and_conversions(spark):
    df = spark.createDataFrame([("1", "a"), ("2.5", "b"), ("2025-01-02", None), ("x", "c"), (None, "d")], "m string, t string")
    found = {r["column_name"]: r for r in profile.type_profile(df).collect()}
    m = found["m"]
    assert (m["integer_count"], m["decimal_count"], m["date_count"], m["text_count"], m["is_mixed"]) == (1, 1, 1, 1, True)
    assert found["t"]["is_mixed"] is False and found["t"]["non_null_count"] == 4
    stats = rows(profile.conversion_stats(df, {"m": "integer"}))
    assert stats == [("m", "date", "null", 1), ("m", "decimal", "integer", 1), ("m", "integer", "integer", 1), ("m", "text", "null", 1)]


def test_good_and_rejected_add_up(spark):
    df = spark.createDataFrame(
        [(1, "5", "2025-01-02", "x"), (2, "five", "2025-01-02", "x"), (3, "5", "someday", "y" * 4001), (4, " ", None, None)],
        "id int, n string, d string, t string",
    )
    done = rejects.convert_table(df, {"n": "integer", "d": "timestamp", "t": "text"})
    assert [r["id"] for r in rejects.good_rows(done).orderBy("id").collect()] == [1, 4]
    bad = {r["_reject_reasons"]: r["_source_row"] for r in rejects.rejected_rows(done).collect()}
    assert set(bad) == {"n:not_integer", "d:not_timestamp;t:too_long"}
    assert '"n":"five"' in bad["n:not_integer"]


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "a"), (None, None)], "Id int, code string")
    assert rows(constraints.primary_key_violations(df, ["ID"])) == [(None, 2, "null_key"), (1, 2, "duplicate_key")]
    assert rows(constraints.unique_violations(df, ["id"])) == [(1, 2, "duplicate_key")]
    parent = spark.createDataFrame([(1, "a"), (2, "a")], "pid int, pcode string")
    orphans = constraints.foreign_key_violations(df, ["id", "code"], parent, ["PID", "pcode"])
    assert rows(orphans) == [(1, "b", 1, "orphan_key")]
    spec = {"primary_key": ["id"], "foreign_keys": [{"columns": ["code"], "reference_table": "P", "reference_columns": ["pcode"]}]}
    found = constraints.check_constraints(df, spec, {"p": parent})
    assert {r["constraint_type"] for r in found.collect()} == {"primary_key", "foreign_key"}
    with pytest.raises(ValueError, match="missing"):
        constraints.constraint_columns(df, {"indexes": [{"columns": ["missing"]}]})


def test_unread_dates_are_counted_over_every_order(spark, monkeypatch):
    from tideline.suite import guards

    runs, whole = [], guards.run_table
    monkeypatch.setattr(guards, "run_table", lambda *a, **b: runs.append(whole(*a, **b)) or runs[-1])
    guards.dates_unread_counted(spark, "/root/testdata/sf0.001")
    assert [r.total_rows for r in runs] == [spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()]
