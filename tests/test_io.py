"""Sources, sinks, streams and runs."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tideline.plans.run import run_report, run_summary, run_table, run_tables
from tideline.plans.spec import table_spec
from tideline.sinks import fixed_width as fixed_sink
from tideline.sinks import history, tables
from tideline.sources import database, dbf_format, delimited, fixed_width, many, sql
from tideline.streaming.ingest import append_stream, for_each_batch, stream_files


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def write(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(text.encode(encoding))
    return str(path)


def test_ragged_delimited(spark, tmp_path):
    path = write(f"{tmp_path}/ragged.csv", 'id,name,note\n1,a,b\n2,"",NULL\n3,x\n4,y,z,extra\n5, padded ,N/A\n6,na,n/a\n')
    df = delimited.read_delimited(spark, path)
    assert rows(df) == [("1", "a", "b"), ("2", None, None), ("3", "x", None), ("4", "y", "z"), ("5", " padded ", None), ("6", "na", None)]
    bad = delimited.ragged_rows(delimited.read_delimited(spark, path, keep_corrupt=True))
    assert rows(bad.select("id", "_corrupt_record")) == [("3", "3,x"), ("4", "4,y,z,extra")]
    assert bad.count() == 2


def test_delimited_options(spark, tmp_path):
    path = write(f"{tmp_path}/x.txt", "1;caf\xe9\n2;-\n", "windows-1252")
    options = delimited.split_options({"separator": ";", "has_header": False, "null_values": ["-"], "encoding": "windows-1252", "infer_schema_length": 9})
    assert rows(delimited.read_delimited(spark, path, **options)) == [("1", "caf\xe9"), ("2", None)]


def test_uneven_files_union(spark, tmp_path):
    paths = [
        write(f"{tmp_path}/a b.csv", "id,x\n1,p\n"),
        write(f"{tmp_path}/c+d.csv", "y,id\nq,2\n"),
        write(f"{tmp_path}/e.csv", "id,x\n3,NULL\n"),
    ]
    df = many.read_delimited_files(spark, paths)
    assert df.columns == ["id", "x", "y", "_source_file"]
    assert rows(df) == [("1", "p", None, paths[0]), ("2", None, "q", paths[1]), ("3", None, None, paths[2])]
    # two distinct headers, so two scans
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2


def test_folders_with_subfolders(spark, tmp_path):
    flat = write(f"{tmp_path}/flat.csv", "id,x\n1,p\n")
    write(f"{tmp_path}/parts/country=de/part-0.csv", "id,x\n2,q\n")
    write(f"{tmp_path}/parts/country=a%2Fb+c/part-1.csv", "x,id,country\nr,3,own\n")
    write(f"{tmp_path}/parts/country=__HIVE_DEFAULT_PARTITION__/day=1/part-0.csv", "id,x\n4,s\n")
    write(f"{tmp_path}/parts/top.csv", "id,x\n5,t\n")
    write(f"{tmp_path}/parts/_temporary/0/part-9.csv", "id,x\n9,no\n")
    write(f"{tmp_path}/deep/2024/01/a.csv", "id,x\n6,u\n")
    df = many.read_delimited_files(spark, [flat, f"{tmp_path}/parts", f"{tmp_path}/deep"])
    want = [("1", "p", None, None), ("2", "q", "de", None), ("3", "r", "a/b+c", None), ("4", "s", None, "1"), ("5", "t", None, None), ("6", "u", None, None)]
    assert rows(df.select("id", "x", "country", "day")) == want
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        os.makedirs(f"{tmp_path}/none")
        many.read_delimited_files(spark, [flat, f"{tmp_path}/none"])
    for name, source, n in (("A", ["flat.csv", "parts"], 5), ("B", "parts", 4), ("C", "deep", 1)):
        run = run_table(spark, {"source_file_path": source, "target_table": name}, str(tmp_path), f"{tmp_path}/out")
        assert (run.error, run.total_rows) == (None, n)
    assert rows(spark.read.parquet(f"{tmp_path}/out/B").select("id", "country"))[0] == ("2", "de")


def test_missing_files(spark, tmp_path):
    write(f"{tmp_path}/a.csv", "id\n1\n")
    assert many.resolve_files(spark, ["a.csv"], str(tmp_path)) == [f"{tmp_path}/a.csv"]
    with pytest.raises(many.MissingFiles, match="b.csv"):
        many.resolve_files(spark, ["a.csv", "b.csv"], str(tmp_path))


def test_mixed_types_union(spark, tmp_path):
    spark.range(2).withColumn("v", F.lit(1)).write.parquet(f"{tmp_path}/one")
    spark.createDataFrame([(5, "text")], "id bigint, v string").write.parquet(f"{tmp_path}/two")
    df = many.read_typed_files(spark, [f"{tmp_path}/one", f"{tmp_path}/two"])
    assert rows(df.select("id", "v")) == [("0", "1"), ("1", "1"), ("5", "text")]


DBF_FIELDS = [
    fixed_width.Field("ID", "N", 6), fixed_width.Field("PRICE", "N", 9, 2), fixed_width.Field("NAME", "C", 8),
    fixed_width.Field("DAY", "D", 8), fixed_width.Field("OK", "L", 1),
]


def dbf_bytes(records):
    return dbf_format.header_bytes(DBF_FIELDS, len(records)) + b"".join(records) + b"\x1a"


def test_dbf_with_deleted_rows_and_legacy_bytes(spark, tmp_path):
    records = [
        b"     12    12.00caf\xe9    20250703T", b"*     2     1.50gone    20250703F", b"     07    -7.25\x80 \x81     00000000?",
        b"                 007             ",
    ]
    with open(f"{tmp_path}/t.dbf", "wb") as f:
        f.write(dbf_bytes(records))
    header = dbf_format.read_header(f"{tmp_path}/t.dbf")
    assert (header.records, header.record_length, list(header.fields)) == (4, 33, DBF_FIELDS)
    got = fixed_width.read_dbf(spark, f"{tmp_path}/t.dbf", records_per_task=1)
    assert rows(got, F.col("ID").asc_nulls_last()) == [
        ("12", "12", "caf\xe9", "2025-07-03", "True"), ("7", "-7.25", "€ �", "00000000", None), (None, None, "007", None, None),
    ]
    kept = fixed_width.read_dbf(spark, str(tmp_path), deleted="keep")
    assert kept.filter("_deleted").count() == 1 and kept.count() == 4


def test_large_dbf_is_read_by_many_tasks(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").cast("string").alias("code"), F.lit("中文").alias("word"))
    fields = [fixed_width.Field("code", "C", 6), fixed_width.Field("word", "C", 7)]
    fixed_sink.write_dbf(df.coalesce(1), f"{tmp_path}/big", fields, encoding="Big5")
    got = fixed_width.read_dbf(spark, f"{tmp_path}/big", encoding="Big5", records_per_task=100)
    assert got.rdd.getNumPartitions() == 10
    assert rows(got) == sorted((str(i), "中文") for i in range(1000))
    fixed_sink.write_dbf(df.limit(5), f"{tmp_path}/big", fields, encoding="Big5")
    assert fixed_width.read_dbf(spark, f"{tmp_path}/big", encoding="Big5").count() == 5


def test_dbf_layouts_union_with_lineage(spark, tmp_path):
    one = [fixed_width.Field("A", "C", 3)]
    two = [fixed_width.Field("A", "C", 5), fixed_width.Field("B", "C", 2)]
    for name, fields, body in (("x.dbf", one, b" a  "), ("y.dbf", two, b" bb   q "), ("z.dbf", one, b" c  ")):
        with open(f"{tmp_path}/{name}", "wb") as f:
            f.write(dbf_format.header_bytes(fields, 1) + body + b"\x1a")
    spec = {"source_type": "dbf", "source_file_path": ["x.dbf", "y.dbf", "z.dbf"], "target_table": "T"}
    run = run_table(spark, spec, str(tmp_path), f"{tmp_path}/out")
    assert (run.total_rows, run.quality_passed) == (3, True)
    got = spark.read.parquet(f"{tmp_path}/out/T")
    assert rows(got) == [("a", None, f"{tmp_path}/x.dbf"), ("bb", "q", f"{tmp_path}/y.dbf"), ("c", None, f"{tmp_path}/z.dbf")]


def test_fixed_text_run_with_lineage(spark, tmp_path):
    paths = [write(f"{tmp_path}/a.txt", "001 x\n"), write(f"{tmp_path}/b.txt", "002 y\n")]
    fields = [{"name": "code", "kind": "C", "length": 3}, {"name": "v", "kind": "C", "length": 2}]
    spec = {"source_type": "fixed_text", "source_file_path": paths, "source_options": {"fields": fields}, "target_table": "T"}
    assert run_table(spark, spec, None, f"{tmp_path}/out").total_rows == 2
    assert rows(spark.read.parquet(f"{tmp_path}/out/T")) == [("001", "x", paths[0]), ("002", "y", paths[1])]


def test_fixed_text_overflow_is_reported(spark, tmp_path):
    df = spark.createDataFrame([(123, "abcdef"), (1, "x")], "n int, c string")
    fields = [fixed_width.Field("n", "N", 2), fixed_width.Field("c", "C", 4)]
    assert rows(fixed_sink.overflows(df, fields)) == [("c", "abcdef", 4), ("n", "123", 2)]
    fields = fixed_sink.write_fixed_text(df, f"{tmp_path}/out")
    assert [(f.kind, f.length) for f in fields] == [("N", 10), ("C", 10)]
    assert rows(fixed_width.read_fixed_text(spark, f"{tmp_path}/out", fields)) == [("1", "x"), ("123", "abcdef")]


def test_sql_aliases_do_not_leak(spark):
    spark.range(1).createOrReplaceTempView("t")
    out = sql.run_sql(spark, "WITH x AS (SELECT * FROM t) SELECT count(*) AS n FROM x -- comment", {"t": spark.range(7)})
    assert out.first()["n"] == 7 and spark.table("t").count() == 1
    assert sql.source_aliases(["a"], 2) == ["source_table_1", "source_table_2"]
    assert sql.source_aliases(None, 1) == ["source_table"]
    with pytest.raises(sql.EmptyInput):
        sql.run_sql(spark, " ; ", {})


def test_jdbc_options():
    whole = database.table_options("jdbc:x", "T", "HR")
    assert whole["dbtable"] == "HR.T" and "partitionColumn" not in whole
    split = database.table_options("jdbc:x", "T", split_column="id", lower=0, upper=9, partitions=3)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "0", "9", "3")
    with pytest.raises(ValueError):
        database.table_options("jdbc:x", "T", split_column="id")
    assert database.query_options("jdbc:x", "SELECT 1;")["query"] == "SELECT 1"
    for size in (0, 100_001, 1.5):
        with pytest.raises(ValueError):
            tables.check_batch_size(size)


def test_streams_append_once(spark, tmp_path):
    write(f"{tmp_path}/in/a.csv", "id,v\n1,x\n2,NULL\n")
    write(f"{tmp_path}/in/b.csv", "id,v\n3,y\n")
    out, log = f"{tmp_path}/out", f"{tmp_path}/log"
    for extra in (None, "id,v\n4,z\n"):
        if extra:
            write(f"{tmp_path}/in/c.csv", extra)
        append_stream(stream_files(spark, f"{tmp_path}/in", ["id", "v"]), out, log, timeout=120)
    assert rows(spark.read.parquet(out).select("id", "v")) == [("1", "x"), ("2", None), ("3", "y"), ("4", "z")]


def test_batches_run_once_per_file(spark, tmp_path):
    for i in range(3):
        write(f"{tmp_path}/in/{i}.csv", f"id\n{i}\n{i}\n")
    seen = []

    def step(batch):
        seen.append(batch.count())
        return batch.distinct()

    stream = stream_files(spark, f"{tmp_path}/in", ["id"])
    for _ in range(2):
        for_each_batch(stream, step, f"{tmp_path}/out", f"{tmp_path}/log", timeout=120)
    assert seen == [2, 2, 2]
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("id")) == [("0",), ("1",), ("2",)]


def test_history(spark, tmp_path):
    from tideline.operators.reconcile import row_count_check

    path = f"{tmp_path}/history"
    for n in (1, 2):
        history.append_history(row_count_check(spark.range(1), spark.range(n), "A"), path)
    history.append_history(row_count_check(spark.range(1), spark.range(1), "B"), path)
    got = history.read_history(spark, path, "A")
    assert got.columns == list(history.HISTORY_COLUMNS)
    assert [r["STATUS"] for r in got.collect()] == ["FAILED", "PASSED"]
    assert history.read_history(spark, path).count() == 3


def test_spec_validation():
    with pytest.raises(ValueError, match="source_file_path"):
        table_spec({"target_table": "T"})
    with pytest.raises(ValueError, match="target_table"):
        table_spec({"target_table": "", "source_file_path": "x"})
    with pytest.raises(ValueError, match="batch size"):
        table_spec({"target_table": "T", "source_file_path": "x", "batch_size": 0})
    with pytest.raises(ValueError, match="data_source"):
        table_spec({"target_table": "T", "source_type": "custom_query", "custom_query": "q.sql"})
    with pytest.raises(ValueError, match="unknown settings"):
        table_spec({"target_table": "T", "source_file_path": "x", "surprise": 1})
    spec = table_spec({"target_table": "T", "source_file_path": "x", "csv_options": {"separator": ";"}, "data_quality_checks": {"sample_percentage": 15}})
    assert spec.source_options == {"separator": ";"} and spec.quality.sample_percentage == 15.0


def test_run_with_dirty_headers_and_lineage(spark, tmp_path):
    paths = [write(f"{tmp_path}/a.csv", "order id,When On\n1,2025-01-02\n2,NULL\n"), write(f"{tmp_path}/b.csv", "order id,extra\n3,x\n")]
    spec = {
        "source_file_path": ["a.csv", "b.csv"], "target_table": "T", "primary_key": ["ORDER ID"],
        "data_quality_checks": {"sample_percentage": 100},
    }
    run = run_table(spark, spec, str(tmp_path), f"{tmp_path}/out", history_path=f"{tmp_path}/h")
    assert (run.loaded, run.count_confirmed, run.quality_passed, run.violations, run.total_rows) == (True, True, True, 0, 3)
    assert rows(spark.read.parquet(f"{tmp_path}/out/T")) == [
        ("1", "01/02/2025", None, paths[0]), ("2", None, None, paths[0]), ("3", None, "x", paths[1]),
    ]
    assert history.read_history(spark, f"{tmp_path}/h", "T").count() == 2
    spec["drop_if_exists"] = False
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_table(spark, spec, str(tmp_path), f"{tmp_path}/out")


def test_parents_come_from_the_target_folder(spark, tmp_path):
    write(f"{tmp_path}/p.csv", "ID,name\n1,a\n2,b\n")
    write(f"{tmp_path}/c.csv", "cid,parent\n10,1\n11,7\n12,7\n")
    child = {
        "source_file_path": "c.csv", "target_table": "CHILD", "row_id": "hash",
        "foreign_keys": [
            {"columns": ["PARENT"], "references_table": "PARENT", "references_columns": ["id"]},
            {"columns": ["cid"], "references_table": "NOWHERE", "references_columns": ["id"]},
        ],
    }
    runs = run_tables(spark, {"p": {"source_file_path": "p.csv", "target_table": "PARENT"}, "c": child}, str(tmp_path), f"{tmp_path}/out")
    assert [(r.error, r.violations) for r in runs] == [(None, 0), (None, 1)]
    assert runs[1].unchecked_keys == ["NOWHERE"] and runs[1].quality_passed
    assert spark.read.parquet(f"{tmp_path}/out/CHILD").columns == ["U_ID", "cid", "parent"]


@pytest.mark.parametrize("target", ["csv", "dbf", "fixed_text", "orc"])
def test_file_targets(spark, tmp_path, target):
    write(f"{tmp_path}/a.csv", "id,name\n1,a\n2,b\n")
    run = run_table(spark, {"source_file_path": "a.csv", "target_table": "T", "target_type": target}, str(tmp_path), str(tmp_path))
    assert (run.total_rows, run.count_confirmed, run.quality_passed) == (2, True, True)
    assert os.listdir(f"{tmp_path}/T")


def test_empty_and_failing_tables_are_reported(spark, tmp_path):
    write(f"{tmp_path}/empty.csv", "id,name\n")
    write(f"{tmp_path}/good.csv", "id,name\n1,a\n")
    base = {"target_type": "parquet"}
    runs = run_tables(
        spark,
        {
            "e": {**base, "source_file_path": "empty.csv", "target_table": "E"},
            "g": {**base, "source_file_path": "good.csv", "target_table": "G"},
            "m": {**base, "source_file_path": "missing.csv", "target_table": "M"},
            "bad": {"target_table": "B"},
        },
        str(tmp_path), str(tmp_path), parallel=2,
    )
    assert [(r.table_name, r.loaded) for r in runs] == [("E", False), ("G", True), ("M", False), ("B", False)]
    assert "empty" in runs[0].error and "missing.csv" in runs[2].error
    assert tuple(run_summary(run_report(spark, runs)).first()) == (4, 1, 3, 1, 1)
