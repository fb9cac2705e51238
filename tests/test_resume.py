"""Runs that go on after a failure, and date layouts solved from shapes."""

from __future__ import annotations

import datetime
import itertools
import os

import pytest

from tideline.operators.date_shapes import datetime_shapes, rewrite_by_shape, solve
from tideline.plans import run as run_module
from tideline.plans.run import run_tables

SPEC = {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "normalize_dates": False}


@pytest.fixture
def extractions(monkeypatch):
    """Counts how often a source is read."""
    seen, plain = [], run_module.read_source
    monkeypatch.setattr(run_module, "read_source", lambda spark, spec, data_dir=None: seen.append(spec.target_table) or plain(spark, spec, data_dir))
    return seen


def failing(stage, monkeypatch):
    def fail(*_, **__):
        raise RuntimeError("down")

    monkeypatch.setattr(run_module, {"check": "run_checks", "load": "_write"}[stage], fail)


@pytest.mark.parametrize("stage", ["check", "load"])
def test_a_failed_run_goes_on(spark, tmp_path, monkeypatch, extractions, stage):
    base, ledger = str(tmp_path), f"{tmp_path}/ledger"
    spark.range(20).write.parquet(f"{base}/in")
    go = lambda spec=SPEC: run_tables(spark, {"t": spec}, base, base, ledger_dir=ledger)[0]
    with monkeypatch.context() as m:
        failing(stage, m)
        first = go()
    assert (first.failed_stage, first.resumed_after, first.loaded) == (stage, None, stage == "check")
    second = go()
    assert (second.failed_stage, second.resumed_after, second.quality_passed) == (None, "load" if stage == "check" else "extract", True)
    assert len(extractions) == 1 and spark.read.parquet(f"{base}/T").count() == second.total_rows == 20
    # finished: nothing is kept, and the next run starts anew
    assert [n for n in os.listdir(ledger) if n.endswith(".json")] == []
    assert go().resumed_after is None and len(extractions) == 2


def test_what_changed_starts_anew(spark, tmp_path, monkeypatch, extractions):
    base, ledger = str(tmp_path), f"{tmp_path}/ledger"
    spark.range(20).write.parquet(f"{base}/in")
    go = lambda spec=SPEC: run_tables(spark, {"t": spec}, base, base, ledger_dir=ledger)[0]
    with monkeypatch.context() as m:
        failing("check", m)
        go()
    spark.range(5).write.mode("append").parquet(f"{base}/in")
    with monkeypatch.context() as m:
        failing("check", m)
        assert go().resumed_after is None
    assert go({**SPEC, "primary_key": ["id"]}).resumed_after is None
    assert spark.read.parquet(f"{base}/T").count() == 25 and len(extractions) == 3
    with monkeypatch.context() as m:
        failing("check", m)
        go()
    with open(f"{ledger}/T.json", "w") as f:  # a crash cut the entry short
        f.write('{"finger')
    if os.path.exists(f"{ledger}/.T.json.crc"):
        os.remove(f"{ledger}/.T.json.crc")
    assert go().resumed_after is None


def test_random_row_ids_are_written_again(spark, tmp_path, monkeypatch, extractions):
    base = str(tmp_path)
    spark.range(4).write.parquet(f"{base}/in")
    spec = {**SPEC, "row_id": "random"}
    with monkeypatch.context() as m:
        failing("check", m)
        run_tables(spark, {"t": spec}, base, base, ledger_dir=f"{base}/ledger")
    run = run_tables(spark, {"t": spec}, base, base, ledger_dir=f"{base}/ledger")[0]
    assert (run.resumed_after, run.loaded, run.quality_passed) == ("extract", True, True) and len(extractions) == 1


DAYS = [datetime.datetime(2023, 1, 1) + datetime.timedelta(days=17 * k, minutes=611 * k, seconds=7 * k) for k in range(60)]
LAYOUTS = {
    "%d.%m.%Y": "d.M.yyyy", "%Y/%m/%d": "yyyy/M/d", "%m/%d/%Y": "M/d/yyyy", "%d/%m/%Y": "d/M/yyyy", "%Y-%m-%d": "yyyy-M-d", "%d-%m-%Y %H:%M": "d-M-yyyy H:m",
    "%Y-%m-%dT%H:%M:%SZ": "yyyy-M-d'T'H:m:s'Z'", "%Y-%m-%d %H:%M:%S.%f": "yyyy-M-d H:m:s.SSSSSS", "%m/%d/%Y %I:%M %p": "M/d/yyyy h:m a", "%Y%m%d": "yyyyMMdd", "%Y%m%d%H%M%S": "yyyyMMddHHmmss", "%Y/%d/%m": "yyyy/d/M",
}


@pytest.mark.parametrize("given", LAYOUTS)
def test_layouts_are_solved_and_read(spark, given):
    df = spark.createDataFrame([(d.strftime(given), f" {d.strftime(given)} ") for d in DAYS], "a string, b string")
    found = datetime_shapes(df)
    assert list(found["a"].values()) == [LAYOUTS[given]] and found["b"] == found["a"]
    timed = "%H" in given or "%I" in given
    want = sorted(d.strftime("%m/%d/%Y %I:%M %p" if timed else "%m/%d/%Y") for d in DAYS)
    assert sorted(r["a"] for r in rewrite_by_shape(df, found).collect()) == want


def test_orders_that_values_leave_open():
    early = [(1, 9, 2, 2), (1, 9, 2, 2), (2020, 2024, 4, 4)]
    assert solve("#/#/#", early) == "M/d/yyyy" and solve("#.#.#", early) == "d.M.yyyy" and solve("#-#-#", early) == "d-M-yyyy"
    late = [(1, 9, 1, 2), (1, 31, 1, 2), (2020, 2024, 4, 4)]
    assert solve("#.#.#", late) == "M.d.yyyy"
    for shape, places in (("#.#.#", [(1, 40, 1, 2)] * 3), ("#-#.#", early), ("#/#/# #", [*early, (0, 5, 1, 2)]), ("#/#/# #:# AM", [*early, (0, 5, 1, 2), (0, 5, 1, 2)])):
        assert solve(shape, places) is None
    for places in itertools.permutations(early):
        assert solve("#/#/#", list(places)) in ("M/d/yyyy", "yyyy/M/d", None)


def test_other_columns_are_left_alone(spark):
    rows = [(f"10.0.0.{i}", f"1.2.{i}", f"{i:08d}", f"2024-01-{i % 28 + 1:02d}" if i % 3 else "unknown", None, "") for i in range(100)]
    df = spark.createDataFrame(rows, "ip string, v string, code string, mostly string, n string, e string")
    assert datetime_shapes(df) == {}
    found = datetime_shapes(df, min_share=0.6)
    assert found == {"mostly": {"#-#-#": "yyyy-M-d"}}
    kept = [r["mostly"] for r in rewrite_by_shape(df, found).collect()]
    assert kept.count("unknown") == 34 and "01/02/2024" in kept
    assert [r["mostly"] for r in rewrite_by_shape(df, found, "null").collect()].count(None) == 34
    assert datetime_shapes(df.select("n"), ["n"]) == {} and datetime_shapes(df.limit(0)) == {}
