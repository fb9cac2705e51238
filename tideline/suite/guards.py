"""Runs that must not lose or misread data, and say so where they leave something out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.sample import hash_sample
from tideline.operators.transform import CleaningOptions
from tideline.plans.run import run_report, run_table, run_tables
from tideline.session import scratch_dir
from tideline.sinks.fixed_width import write_fixed_text
from tideline.sinks.tables import write_table
from tideline.sources.delimited import read_delimited
from tideline.sources.fixed_width import Field, read_dbf, read_fixed_text
from tideline.suite.registry import from_sql, query, table


def _one_row(spark: SparkSession, **values) -> DataFrame:
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


# An address column that holds one date, and a day-first column whose early days either order reads.
_GUARDED = """SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE WHEN o_orderkey % 97 = 0 THEN '2024-01-05' ELSE 'Long Street ' || CAST(o_custkey AS VARCHAR) || '-' || CAST(o_orderkey AS VARCHAR) END AS address,
  strf(o_orderdate) AS due FROM orders"""


@query(
    f"""WITH d AS ({_GUARDED.replace("strf(o_orderdate)", "o_orderdate AS day, strftime(o_orderdate, '%d/%m/%Y')")})
    SELECT id, address, strftime(day, '%m/%d/%Y') AS due FROM d"""
)
def dates_guarded(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_dir(spark, "guarded")
    df = from_sql(spark, folder, _GUARDED.replace("strf(o_orderdate)", "date_format(o_orderdate, 'dd/MM/yyyy')"), "orders")
    write_table(df, f"{base}/in", fmt="csv", header=True)
    run_table(spark, {"source_file_path": "in", "target_table": "T"}, base, base)
    return spark.read.parquet(f"{base}/T")


@query(
    """SELECT CAST(count(*) FILTER (o_orderkey % 10 = 0) AS BIGINT) AS dates_unread, CAST(0 AS BIGINT) AS dates_nulled, CAST(count(*) FILTER (o_orderkey % 10 = 0) AS BIGINT) AS kept
    FROM orders"""
)
def dates_unread_counted(spark: SparkSession, folder: str) -> DataFrame:
    """Text that a date column's pattern does not read stays, and is counted."""
    base = scratch_dir(spark, "unread")
    sql = """SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 10 = 0 THEN 'to be agreed' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS ship_date
      FROM orders"""
    write_table(from_sql(spark, folder, sql, "orders"), f"{base}/in")
    spec = {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "date_columns": ["ship_date"], "min_share": 0.5}
    run = run_table(spark, spec, base, base)
    kept = spark.read.parquet(f"{base}/T").where("ship_date = 'to be agreed'").count()
    return _one_row(spark, dates_unread=run.dates_unread, dates_nulled=run.dates_nulled, kept=kept)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d') AS placed FROM orders
    WHERE strftime(o_orderdate, '%Y-%m-%d') >= '1995-01-01'"""
)
def sql_iso_filter_run(spark: SparkSession, folder: str) -> DataFrame:
    """User SQL sees ISO dates as the file has them."""
    base = scratch_dir(spark, "iso")
    sql = "SELECT CAST(o_orderkey AS STRING) AS id, date_format(o_orderdate, 'yyyy-MM-dd') AS placed FROM orders"
    write_table(from_sql(spark, folder, sql, "orders"), f"{base}/in", fmt="csv", header=True)
    spark.createDataFrame([("SELECT id, placed FROM placed_orders WHERE placed >= '1995-01-01'",)], "value string").coalesce(1).write.text(f"{base}/q.sql")
    source = {"type": "csv", "file_path": "in", "table_alias": "placed_orders"}
    run_table(spark, {"source_type": "custom_query", "custom_query": "q.sql", "data_source": source, "target_table": "T"}, base, base)
    return spark.read.parquet(f"{base}/T")


def _checks(spark: SparkSession, runs: dict) -> DataFrame:
    rows = [(name, r["check_type"], r["source_count"], r["target_count"], r["accuracy_percentage"], r["status"]) for name, run in runs.items() for r in run.checks]
    return spark.createDataFrame(rows, "run string, check_type string, source_count long, target_count long, accuracy_percentage double, status string")


@query(
    """WITH n AS (SELECT count(DISTINCT lower(o_orderstatus) || lower(o_orderpriority)) AS n FROM orders)
    SELECT 'declared' AS run, c AS check_type, n AS source_count, n AS target_count, 100.0::DOUBLE AS accuracy_percentage, 'PASSED' AS status
    FROM n, (VALUES ('ROW_COUNT'), ('CONTENT_ACCURACY')) AS t(c)"""
)
def checks_after_operations(spark: SparkSession, folder: str) -> DataFrame:
    """Lower-casing and de-duplication are declared, so they are no loss."""
    base = scratch_dir(spark, "declared")
    sql = "SELECT o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN upper(o_orderpriority) ELSE o_orderpriority END AS o_orderpriority FROM orders"
    write_table(from_sql(spark, folder, sql, "orders"), f"{base}/in")
    steps = [{"column": c, "operation": "lower"} for c in ("o_orderstatus", "o_orderpriority")]
    spec = {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "data_quality_checks": {"sample_percentage": 100}}
    return _checks(spark, {"declared": run_table(spark, spec, base, base, cleaning=CleaningOptions(operations=steps, remove_duplicates=True))})


@query(
    """WITH n AS (SELECT (SELECT count(*) FROM customer) AS c)
    SELECT 'base name' AS run, 'ROW_COUNT' AS check_type, c AS source_count, c AS target_count, 100.0::DOUBLE AS accuracy_percentage, 'PASSED' AS status FROM n
    UNION ALL SELECT 'unknown', 'ROW_COUNT', 0, 0, 0.0::DOUBLE, 'FAILED'"""
)
def checks_by_file_name(spark: SparkSession, folder: str) -> DataFrame:
    """A bare file name selects the file on both sides; one that selects nothing fails."""
    spec = {"source_type": "parquet", "source_file_path": ["customer.parquet", "supplier.parquet"], "target_table": "T"}
    out = {}
    for name, file in (("base name", "customer.parquet"), ("unknown", "nobody.parquet")):
        checks = {"source_file_identifier": file, "enable_content_check": False}
        base = scratch_dir(spark, "byname")
        # One plain file each, whatever the given tables consist of.
        for t in ("customer", "supplier"):
            table(spark, folder, t).write.parquet(f"{base}/in/{t}")
            _as_one_file(spark, f"{base}/in/{t}", f"{base}/{t}.parquet")
        out[name] = run_table(spark, {**spec, "data_quality_checks": checks}, base, base)
    return _checks(spark, out)


def _as_one_file(spark: SparkSession, folder: str, name: str) -> None:
    """Rewrite a folder of part files as one file of the given name."""
    spark.read.parquet(folder).coalesce(1).write.parquet(f"{folder}-one")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(f.getPath() for f in system.listStatus(path(f"{folder}-one")) if f.getPath().getName().startswith("part-"))
    system.rename(part, path(name))


_WIDE = """SELECT o_orderkey AS customer_id_one, CAST(o_custkey AS VARCHAR) AS customer_id_two,
  CASE WHEN o_orderkey % 50 = 0 THEN repeat('x', 300) ELSE o_orderpriority END AS note FROM orders"""


@query(
    f"""SELECT CAST(customer_id_one AS VARCHAR) AS customer_i, customer_id_two AS customer_1, note, CAST(NULL AS BIGINT) AS rejected FROM ({_WIDE}) WHERE length(note) <= 254
    UNION ALL SELECT NULL, NULL, NULL, count(*) FROM ({_WIDE}) WHERE length(note) > 254"""
)
def dbf_overflow_run(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that do not fit go to the rejects, all others arrive whole; clashing names are told apart."""
    base = scratch_dir(spark, "wide")
    write_table(from_sql(spark, folder, _WIDE, "orders"), f"{base}/in")
    run = run_table(spark, {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "target_type": "dbf"}, base, base)
    rejected = spark.read.parquet(run.rejects_path).agg(F.count("*").alias("rejected"))
    return read_dbf(spark, f"{base}/T").unionByName(rejected, allowMissingColumns=True)


@query(
    """WITH d AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE CAST(o_custkey AS VARCHAR) END AS customer FROM orders)
    SELECT count(*) AS n_rows, CAST(count(*) FILTER (customer <> 'unknown') AS BIGINT) AS good, CAST(count(*) FILTER (customer = 'unknown') AS BIGINT) AS rejected,
      CAST(sum(TRY_CAST(customer AS BIGINT)) AS BIGINT) AS total, CAST(count(*) FILTER (customer = 'unknown') AS BIGINT) AS named FROM d"""
)
def run_with_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Good rows and rejects of a typed run add up to the input."""
    base = scratch_dir(spark, "typed")
    sql = "SELECT CAST(o_orderkey AS STRING) AS id, CASE WHEN o_orderkey % 13 = 0 THEN 'unknown' ELSE CAST(o_custkey AS STRING) END AS customer FROM orders"
    write_table(from_sql(spark, folder, sql, "orders"), f"{base}/in")
    spec = {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "column_types": {"id": "integer", "customer": "integer"}}
    run = run_table(spark, spec, base, base)
    named = spark.read.parquet(run.rejects_path).where("_reject_reasons = 'customer:not_integer'").count()
    total = spark.read.parquet(f"{base}/T").agg(F.sum("customer")).first()[0]
    return _one_row(spark, n_rows=run.total_rows + run.rejected_rows, good=run.total_rows, rejected=run.rejected_rows, total=total, named=named)


_QUOTED = """SELECT CAST(doc_id AS VARCHAR) AS id, 'a, "quoted" word; ' || source AS text FROM documents"""


@query(_QUOTED)
def csv_quoted_defaults(spark: SparkSession, folder: str) -> DataFrame:
    """Doubled quotes are read without any option."""
    base = scratch_dir(spark, "quoted")
    write_table(from_sql(spark, folder, _QUOTED, "documents"), f"{base}/in", fmt="csv", header=True, escape='"')
    return read_delimited(spark, f"{base}/in")


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, NULL AS extra FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, 'x' FROM supplier"""
)
def folder_mixed_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One folder holds files whose columns differ in order and number."""
    base = scratch_dir(spark, "mixed")
    table(spark, folder, "customer").selectExpr("c_custkey AS id", "c_name AS name").write.csv(f"{base}/in", header=True)
    table(spark, folder, "supplier").selectExpr("'x' AS extra", "s_name AS name", "s_suppkey AS id").write.mode("append").csv(f"{base}/in", header=True)
    run_table(spark, {"source_file_path": "in", "target_table": "T"}, base, base)
    return spark.read.parquet(f"{base}/T")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, 'café ' || CAST(c_nationkey AS VARCHAR) AS place, c_mktsegment AS segment FROM customer")
def fixed_text_codepage(spark: SparkSession, folder: str) -> DataFrame:
    """Fields of a one-byte codepage are cut as bytes, so letters with accents shift nothing."""
    base = scratch_dir(spark, "codepage")
    fields = [Field("id", "C", 10), Field("place", "C", 9), Field("segment", "C", 12)]
    df = from_sql(spark, folder, "SELECT CAST(c_custkey AS VARCHAR) AS id, 'café ' || CAST(c_nationkey AS VARCHAR) AS place, c_mktsegment AS segment FROM customer", "customer")
    write_fixed_text(df, f"{base}/utf8", fields)
    lines = spark.read.text(f"{base}/utf8")
    lines.write.option("encoding", "windows-1252").csv(f"{base}/in", encoding="windows-1252", quote="", escape="", sep="\x01", ignoreTrailingWhiteSpace=False)
    return read_fixed_text(spark, f"{base}/in", fields, encoding="windows-1252")


@query("SELECT CAST(100 AS BIGINT) AS n_rows, TRUE AS all_different")
def sample_by_shared_key(spark: SparkSession, folder: str) -> DataFrame:
    """A key that does not identify a row still samples different rows."""
    rows = hash_sample(table(spark, folder, "lineitem"), 100, ["l_returnflag"])
    return rows.agg(F.count("*").alias("n_rows"), (F.countDistinct("l_orderkey", "l_linenumber") == 100).alias("all_different"))


@query("SELECT 'extract' AS failed_stage, FALSE AS extracted, FALSE AS loaded, CAST(0 AS BIGINT) AS total_rows, TRUE AS refused FROM (SELECT count(*) FROM region)")
def empty_refused(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_dir(spark, "empty")
    table(spark, folder, "region").where("r_regionkey < 0").write.parquet(f"{base}/in")
    spec = {"source_type": "parquet", "source_file_path": "in", "target_table": "T"}
    report = run_report(spark, run_tables(spark, {"t": spec}, base, base))
    return report.select("failed_stage", "extracted", "loaded", "total_rows", F.contains("error", F.lit("empty")).alias("refused"))


@query(
    """SELECT 'CHILD' AS table_name, TRUE AS loaded, TRUE AS quality_passed, (SELECT count(*) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey % 7 = 0)) AS violations,
      (SELECT count(*) FROM orders) AS total_rows, NULL AS failed_stage, NULL AS unchecked
    UNION ALL SELECT 'PARENT', TRUE, TRUE, 0, (SELECT count(*) FROM customer WHERE c_custkey % 7 <> 0), NULL, NULL
    UNION ALL SELECT 'LOST', TRUE, TRUE, 0, (SELECT count(*) FROM nation), NULL, 'NOBODY'
    UNION ALL SELECT 'WRONG', FALSE, FALSE, NULL, 0, 'spec', NULL"""
)
def tables_by_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A child listed before its ORC parent, an unknown parent, and a key without its columns."""
    base = scratch_dir(spark, "keys")
    from_sql(spark, folder, "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer WHERE c_custkey % 7 <> 0", "customer").write.parquet(f"{base}/p")
    key = {"columns": ["o_custkey"], "references_table": "PARENT", "references_columns": ["c_custkey"]}
    specs = {
        "child": {"source_type": "parquet", "source_file_path": f"{folder}/orders.parquet", "target_table": "CHILD", "foreign_keys": [key]},
        "parent": {"source_type": "parquet", "source_file_path": f"{base}/p", "target_table": "PARENT", "target_type": "orc", "primary_key": ["c_custkey"]},
        "lost": {"source_type": "parquet", "source_file_path": f"{folder}/nation.parquet", "target_table": "LOST", "foreign_keys": [{**key, "columns": ["n_regionkey"], "references_table": "NOBODY"}]},
        "wrong": {"source_type": "parquet", "source_file_path": f"{folder}/region.parquet", "target_table": "WRONG", "foreign_keys": [{"columns": ["r_regionkey"], "references_table": "PARENT"}]},
    }
    report = run_report(spark, run_tables(spark, specs, None, base, parallel=2))
    return report.select(
        "table_name", "loaded", "quality_passed", "violations", "total_rows", "failed_stage", F.nullif(F.array_join("unchecked_keys", ","), F.lit("")).alias("unchecked")
    )
