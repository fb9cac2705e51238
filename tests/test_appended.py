"""Nearest rows against comparing all, keys across batches against a set, streams across restarts."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import appended, nearest
from tideline.operators.appended import append_batch, appended_key_violations, claimed, key_filter, possible_clashes
from tideline.operators.nearest import nearest_for_all
from tideline.sinks.history import read_history
from tideline.streaming.ingest import append_stream, counted_append, stream_files, without_repeats


def brute(missing, target):
    out = []
    for row in sorted(set(missing)):
        best = min(((-sum(a == b for a, b in zip(row, t)), t) for t in target), default=(0, (None,) * len(row)))
        out.append((-best[0], *row, *best[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("lookups", "sets"), [(1000, 256), (0, 256), (0, 0), (5, 6), (30, 20)])
def test_nearest_equals_comparing_all(spark, lookups, sets, monkeypatch):
    monkeypatch.setattr(nearest, "MOST_LOOKUPS", lookups)
    monkeypatch.setattr(nearest, "MOST_SETS", sets)
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 20)
    rng = random.Random(4)
    value = lambda k: rng.choice([f"k{rng.randint(0, 400)}", "", "a b"] if k == 0 else ["x", "y", "z", ""][: k + 1])
    target = [tuple(value(k) for k in range(5)) for _ in range(150)]
    missing = [tuple(value(k) for k in range(5)) for _ in range(25)] + [("none",) * 5, ("none", "x", "-", "-", "-")]
    missing = [r for r in missing if r not in target] + [missing[0]]
    names = ["a", "b `q`", "c", "d.e", "f"]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    got = nearest_for_all(spark.createDataFrame(missing, schema), spark.createDataFrame(target, schema).repartition(3), names)
    assert sorted(map(tuple, got.collect()), key=str) == brute(missing, target)


def test_nearest_of_nothing(spark):
    some, none = spark.createDataFrame([("1", "a")], "k string, v string"), spark.createDataFrame([], "k string, v string")
    assert [tuple(r) for r in nearest_for_all(some, none, ["k", "v"]).collect()] == [(0, "1", "a", None, None)]
    assert nearest_for_all(none, some, ["k", "v"]).collect() == []


def test_nearest_moves_only_targets_that_open_rows_may_need(spark, monkeypatch):
    """A value that many rows share is no reason to pair each of them with each target row that has it."""
    moved = []

    def counted(*args):
        out = claimed(*args)
        moved.append(out.where("set IS NOT NULL").count())
        return out

    monkeypatch.setattr(nearest, "claimed", counted, raising=False)
    target = [(f"k{i}", f"c{i // 10}", "same price", "z") for i in range(600)]
    missing = [(f"k{i}", f"c{i // 10}", "same price", "other") for i in range(0, 600, 5)]
    names = ["k", "c", "p", "s"]
    schema = ", ".join(f"{n} string" for n in names)
    got = nearest_for_all(spark.createDataFrame(missing, schema), spark.createDataFrame(target, schema), names)
    assert sorted(map(tuple, got.collect()), key=str) == brute(missing, target)
    assert len(moved) == 2 and sum(moved) < 3 * len(missing)  # four equal columns, then three


def test_a_full_filter_claims_all_its_keys(spark):
    rows = spark.range(0, 40_000, 2).withColumn("k", F.array(F.col("id").cast("string")))
    words = key_filter(rows, ["k"], 1 << 10)
    assert words.select("__size").distinct().collect()[0][0] == 1 << 10
    asked = spark.range(0, 40_000).withColumn("k", F.array(F.col("id").cast("string")))
    got = claimed(asked, words, ["k"])
    assert got.columns == asked.columns
    assert got.where("id % 2 = 0").count() == 20_000
    assert claimed(asked, key_filter(rows, ["k"]), ["k"]).where("id % 2 = 1").count() < 2_000
    assert claimed(asked, key_filter(rows.limit(0), ["k"]), ["k"]).isEmpty()


def test_keys_across_batches(spark, tmp_path):
    path = f"{tmp_path}/t"
    rng = random.Random(8)
    seen: set = set()
    for n, batch in enumerate(("01", "2024-01", "x")):
        keys = [(rng.randint(0, 3000), rng.choice("ab")) for _ in range(900)] + [(None, "a"), (5, None), (5, None)]
        df = spark.createDataFrame([(k, s, 1.5) for k, s in keys], "k int, s string, v double")
        got = {(r["k"], r["s"]): (r["n_rows"], r["violation"]) for r in appended_key_violations(spark, df, path, ["K", "s"]).collect()}
        want = {}
        for key in set(keys):
            times = keys.count(key)
            if None in key:
                want[key] = (times, "null_key")
            elif key in seen:
                want[key] = (times, "kept_key")
            elif times > 1:
                want[key] = (times, "duplicate_key")
        assert got == want and (n == 0 or any(v == "kept_key" for _, v in want.values()))
        assert append_batch(spark, df, path, ["k", "s"], batch) == len(keys)
        seen |= {k for k in keys if None not in k}
    assert appended.read_batches(spark, path).select("__batch").distinct().count() == 3
    with pytest.raises(ValueError):
        append_batch(spark, df, path, ["k"], "a/b")


def test_filters_claim_all_keys_and_few_others(spark, tmp_path):
    path = f"{tmp_path}/t"
    old = spark.range(20_000).withColumnRenamed("id", "k")
    append_batch(spark, old, path, ["k"], "a")
    append_batch(spark, old.where("k < 50"), path, ["k"], "b")
    assert possible_clashes(spark, old, path, ["k"]).where("__batch = 'a'").count() == 20_000
    others = spark.range(100_000, 120_000).withColumnRenamed("id", "k")
    assert possible_clashes(spark, others, path, ["k"]).where("__batch = 'a'").count() < 1500
    assert key_filter(old, ["k"]).count() <= 4096


def test_old_keys_are_read_only_for_hits(spark, tmp_path):
    path = f"{tmp_path}/t"
    for b in ("a", "b"):
        append_batch(spark, spark.createDataFrame([(f"{b}{i}",) for i in range(50)], "k string"), path, ["k"], b)
    for name in os.listdir(f"{path}/__batch=a"):  # unreadable: nothing may look into this batch
        if name.endswith(".parquet"):
            with open(f"{path}/__batch=a/{name}", "wb") as f:
                f.write(b"broken")
            os.remove(f"{path}/__batch=a/.{name}.crc")
    new = spark.createDataFrame([("b7",), ("new",)], "k string")
    hits = {r[0] for r in possible_clashes(spark, new, path, ["k"]).select("__batch").collect()}
    assert hits == {"b"}
    old = spark.read.schema("k string, __batch string").parquet(path).where("__batch IN ('b')")
    assert all("__batch=b" in f for r in old.select(F.input_file_name()).distinct().collect() for f in r)


def test_a_batch_repeated_after_a_failure(spark, tmp_path):
    path = f"{tmp_path}/t"
    for _ in range(2):
        append_batch(spark, spark.range(10), path, ["id"], "a")
    assert spark.read.parquet(path).count() == 10
    assert appended_key_violations(spark, spark.range(9, 12), path, ["id"]).collect()[0]["violation"] == "kept_key"


def write_file(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("id,v\n" + "".join(f"{i},{v}\n" for i, v in rows))


def test_repeats_are_dropped_across_restarts(spark, tmp_path):
    folder, target, log = (f"{tmp_path}/{n}" for n in ("in", "out", "log"))
    want = set()
    for k, rows in enumerate(([(1, "a"), (2, "b"), (1, "c")], [(2, "x"), (3, "d")], [(1, "z"), (3, "z")])):
        write_file(folder, str(k), rows)
        want |= {str(i) for i, _ in rows}
        append_stream(without_repeats(stream_files(spark, folder, ["id", "v"]), ["ID"]), target, log, timeout=300)
        assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == sorted(want)
    with pytest.raises(ValueError):
        without_repeats(stream_files(spark, folder, ["id", "v"]), ["id"], event_time="v")


def test_batches_are_counted_as_they_pass(spark, tmp_path):
    folder, target, log, history = (f"{tmp_path}/{n}" for n in ("in", "out", "log", "history"))
    write_file(folder, "a", [(1, "a"), (2, "b"), (3, "c")])
    write_file(folder, "b", [(4, "a")])
    count = lambda step: counted_append(stream_files(spark, folder, ["id", "v"]), step, target, log, "T", history, timeout=300)
    assert count(lambda df: df.where("v <> 'b'")) == 2
    write_file(folder, "c", [(5, "a")])
    assert count(lambda df: df.withColumn("v", F.explode(F.array("v", "v")))) == 1
    assert count(lambda df: df) == 0
    rows = sorted((r["SOURCE_COUNT"], r["TARGET_COUNT"], r["STATUS"]) for r in read_history(spark, history, "T").collect())
    assert rows == [(1, 1, "PASSED"), (1, 2, "FAILED"), (3, 2, "PASSED")]
