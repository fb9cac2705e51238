"""Cut quotes, headers of many files, and unions of mixed types, on awkward files."""

from __future__ import annotations

import decimal
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.rejects import good_rows, rejected_rows
from tideline.plans.run import run_table
from tideline.sources import quoted
from tideline.sources.delimited import header_of, headers_of, read_delimited
from tideline.sources.many import file_sizes, read_delimited_files
from tideline.sources.quoted import UnclosedQuote, range_states, read_records
from tideline.sources.records import Dialect
from tideline.sources.relaxed import LossyUnion, common_type, union_relaxed


@pytest.fixture
def ranges(spark):
    """Sets how many bytes a task reads."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def cut(size: int) -> None:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield cut
    for k, v in kept.items():
        spark.conf.set(k, v)


def quoted_file(path, seed, end="\n"):
    rng = random.Random(seed)
    pieces = ["a", "\n", "\n\n", '""', ",", "é", "x y", "\r\n", ',"",\n']

    def cell():
        k = rng.random()
        if k < 0.3:
            return '"' + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) + '"'
        return rng.choice(['mid"dle', "", '5"', "plain", "'", ' "x'])

    rows = "".join(f"{i},{cell()},{cell()}{end}" for i in range(400))
    path.write_bytes(f'id,"two\nlines",c{end}{rows}'.encode())


@pytest.mark.parametrize("size", [100, 700, 1 << 20])
def test_cut_quotes_equal_one_task(spark, tmp_path, ranges, size):
    for seed in (1, 2):
        quoted_file(tmp_path / f"{seed}.csv", seed)
    paths = [str(tmp_path / f"{seed}.csv") for seed in (1, 2)]
    names = ["id", "two\nlines", "c"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    want = spark.read.option("header", True).option("escape", '"').option("multiLine", True).schema(schema).csv(paths)
    want = sorted(map(tuple, want.collect()), key=str)
    ranges(size)
    got = read_delimited(spark, paths, null_tokens=(), reader={"multiLine": True})
    assert got.columns == names
    assert sorted(map(tuple, got.collect()), key=str) == want
    if size == 700:
        assert spark.read.text(paths).rdd.getNumPartitions() > 10
        assert got.rdd.getNumPartitions() > 10


def test_line_ends_of_windows_and_codepages(spark, tmp_path, ranges):
    (tmp_path / "w.csv").write_bytes('id;t\r\n1;"é\r\nñ;"\r\n\r\n2;x\r\n'.encode("windows-1252"))
    ranges(4)
    got = read_delimited(spark, str(tmp_path / "w.csv"), sep=";", encoding="windows-1252", reader={"multiLine": True}, lineage="from")
    assert sorted((r["id"], r["t"], r["from"]) for r in got.collect()) == [("1", "é\r\nñ;", f"{tmp_path}/w.csv"), ("2", "x", f"{tmp_path}/w.csv")]


def test_other_escape_and_ragged_rows(spark, tmp_path, ranges):
    (tmp_path / "e.csv").write_text('a,b\n1,"x\\"\n,y"\n2\n3,z,extra\n')
    ranges(5)
    got = read_delimited(spark, str(tmp_path / "e.csv"), keep_corrupt=True, reader={"multiLine": True, "escape": "\\"})
    found = sorted((r["a"], r["b"], r["_corrupt_record"] is not None) for r in got.collect())
    assert found == [("1", 'x"\n,y', False), ("2", None, True), ("3", "z", True)]


def test_states_compose_along_a_file(spark, ranges, tmp_path):
    quoted_file(tmp_path / "s.csv", 5)
    data = (tmp_path / "s.csv").read_bytes()
    ranges(64)
    d = Dialect()
    states = range_states(quoted._lines(spark, [str(tmp_path / "s.csv")]), d).orderBy(quoted.BLOCK).collect()
    assert len(states) > 50
    inside, at, want = False, 0, {}
    for line in data.split(b"\n")[:-1]:
        want[at] = inside
        inside = d.open_after(line, inside)
        at += len(line) + 1
    for r in states:
        # a range's first line is the first that starts after the cut, or at the file's start
        first = min(p for p in want if p > r[quoted.BLOCK] or p == r[quoted.BLOCK] == 0)
        assert r["starts"] == want[first]


@pytest.mark.parametrize("limit", [0, 100_000])
def test_many_ranges_are_joined_by_a_shuffle(spark, tmp_path, ranges, monkeypatch, limit):
    monkeypatch.setattr(quoted, "BROADCAST_RANGES", limit)
    quoted_file(tmp_path / "s.csv", 6)
    ranges(200)
    records = read_records(spark, [str(tmp_path / "s.csv")], Dialect())
    assert records.count() == 401 and records.where("first").count() == 1


def test_a_quote_that_never_closes_is_refused(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(quoted, "MOST_BYTES", 1000)
    (tmp_path / "o.csv").write_text('a\n"' + "x\n" * 2000)
    with pytest.raises(Exception, match="does not end"):
        read_delimited(spark, str(tmp_path / "o.csv"), reader={"multiLine": True}).count()
    assert issubclass(UnclosedQuote, ValueError)


def test_delimited_target_with_line_breaks_is_read_back(spark, tmp_path):
    rows = [(str(i), f'line {i}\n"quoted", {i}\n') for i in range(50)]
    spark.createDataFrame(rows, "id string, t string").write.parquet(f"{tmp_path}/in")
    spec = {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "target_type": "csv", "data_quality_checks": {"sample_percentage": 100}}
    run = run_table(spark, spec, str(tmp_path), str(tmp_path))
    assert run.quality_passed and run.count_confirmed


HEADERS = [
    b"a,b,a\n1,2,3\n", b'"x,1","y ""q""", z\r\n1,2,3\r\n', b"\n\n,b,,B\n1,2,3,4\n", b"", b"only\n", b"p;q", "é,ñ\n1,2\n".encode(), b'a"b,c"d\n1,2\n', b"\xef\xbb\xbfbom,x\n1,2\n",
]


def test_headers_are_those_of_the_reader(spark, tmp_path):
    paths = [str(tmp_path / f"h {k}+.csv") for k in range(len(HEADERS))]
    for p, data in zip(paths, HEADERS):
        with open(p, "wb") as f:
            f.write(data)
    want = {p: header_of(spark, p) for p in paths}
    assert headers_of(spark, dict.fromkeys(paths, 10)) == want
    assert headers_of(spark, dict.fromkeys(paths, 1 << 40)) == want
    assert headers_of(spark, {paths[1]: 1}, header=False)[paths[1]] == ["column_1", "column_2", "column_3"]
    assert headers_of(spark, {paths[5]: 1}, sep=";")[paths[5]] == ["p", "q"]


def test_one_job_reads_the_headers_of_many_files(spark, tmp_path):
    for i in range(300):
        (tmp_path / f"{i}.csv").write_text("a,b\n1,2\n" if i % 2 else "b,c\n1,2\n")
    spark.sparkContext.setJobGroup("headers", "headers")
    df = read_delimited_files(spark, [str(tmp_path)])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Spark lists so many paths in a job of its own, once for each scan
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) <= 4
    assert len(file_sizes(spark, [str(tmp_path)])) == 300
    assert sorted(df.columns) == ["_source_file", "a", "b", "c"] and df.count() == 300


def types():
    return [
        T.ByteType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.DecimalType(10, 2), T.DecimalType(38, 10), T.DecimalType(20, 18), T.BooleanType(),
        T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.StringType(), T.NullType(), T.ArrayType(T.LongType()),
    ]


def test_common_types_do_not_depend_on_order():
    for a, b, c in itertools.combinations_with_replacement(types(), 3):
        found = {common_type(p).simpleString() for p in itertools.permutations((a, b, c))}
        assert len(found) == 1
    name = lambda *t: common_type(t).simpleString()
    assert name(T.IntegerType(), T.LongType()) == "bigint"
    assert name(T.LongType(), T.DecimalType(10, 2)) == "decimal(21,2)"
    assert name(T.DecimalType(38, 10), T.DecimalType(20, 18)) == "string"
    assert name(T.LongType(), T.FloatType()) == "double"
    assert name(T.DateType(), T.TimestampType()) == "timestamp"
    assert name(T.DateType(), T.LongType()) == "string"
    assert name(T.NullType(), T.NullType()) == "void"


def test_losses_are_refused_rejected_or_kept(spark):
    long = spark.createDataFrame([(1, 2**53 + 1, "a"), (2, 5, None), (3, None, "c")], "Id int, v long, t string")
    double = spark.createDataFrame([(0.5, True)], "v double, b boolean")
    exact = spark.createDataFrame([(decimal.Decimal("0.10"), 7)], "v decimal(10,2), id long")
    frames = [long, double, exact]
    with pytest.raises(LossyUnion, match="v:not_double: 1 values"):
        union_relaxed(frames)
    both = union_relaxed(frames, "reject")
    assert [f.dataType.simpleString() for f in good_rows(both).schema] == ["bigint", "double", "string", "boolean"]
    assert sorted(map(tuple, good_rows(both).collect()), key=str) == sorted([(2, 5.0, None, None), (3, None, "c", None), (None, 0.5, None, True), (7, 0.1, None, None)], key=str)
    (bad,) = rejected_rows(both).collect()
    assert bad["_reject_reasons"] == "v:not_double" and "9007199254740993" in bad["_source_row"]
    assert union_relaxed(frames, "keep").count() == 5
    assert union_relaxed([long.limit(0), double]).count() == 1


def test_typed_files_in_a_run_keep_their_types(spark, tmp_path):
    spark.range(3).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("t")).write.parquet(f"{tmp_path}/a")
    spark.range(3).select(F.col("id").alias("k"), F.current_date().alias("d")).write.parquet(f"{tmp_path}/b")
    spec = {"source_type": "parquet", "source_file_path": ["a", "b"], "source_options": {"relaxed": True}, "normalize_dates": False, "target_table": "T"}
    run = run_table(spark, spec, str(tmp_path), str(tmp_path))
    kinds = dict(spark.read.parquet(f"{tmp_path}/T").dtypes)
    assert run.quality_passed and (kinds["k"], kinds["d"]) == ("bigint", "date")
