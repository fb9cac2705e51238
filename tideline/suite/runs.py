"""Writing, and whole table runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.transform import CleaningOptions
from tideline.operators.reconcile import CHECK_SCHEMA
from tideline.plans.run import run_report, run_summary, run_table, run_tables
from tideline.session import scratch_dir
from tideline.sinks.tables import count_matches, with_row_id, write_delimited, write_table
from tideline.sources.delimited import read_delimited
from tideline.suite.registry import from_sql, query, row_text_sql, table


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier")
def write_modes(spark: SparkSession, folder: str) -> DataFrame:
    """Replace what is there, append, be refused."""
    path = scratch_dir(spark, "modes")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    supplier = table(spark, folder, "supplier").selectExpr("s_suppkey AS c_custkey", "s_name AS c_name")
    write_table(supplier, path, "fail")
    write_table(customer, path, "replace")
    write_table(supplier, path, "append")
    try:
        write_table(customer, path, "fail")
    except Exception as refused:
        if "PATH_ALREADY_EXISTS" not in str(refused):
            raise
    return spark.read.parquet(path)


@query("SELECT count(*) AS written, TRUE AS confirmed, FALSE AS off_by_one FROM lineitem")
def load_count_check(spark: SparkSession, folder: str) -> DataFrame:
    """Rows counted while writing, against rows in the written table."""
    path = scratch_dir(spark, "count")
    written = write_table(table(spark, folder, "lineitem"), path)
    return spark.range(1).select(
        F.lit(written).cast("bigint").alias("written"),
        F.lit(count_matches(spark, path, written)).alias("confirmed"),
        F.lit(count_matches(spark, path, written + 1)).alias("off_by_one"),
    )


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def export_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Long texts with quotes and line breaks survive the export."""
    path = scratch_dir(spark, "export")
    options = {"escape": '"', "multiLine": True}
    write_delimited(table(spark, folder, "documents").select("doc_id", "text", "lang"), path, escape='"', lineSep="\n")
    return read_delimited(spark, path, null_tokens=(), reader=options)


_ID_COLUMNS = ["CAST(o_orderkey AS VARCHAR)", "CAST(o_custkey AS VARCHAR)", "o_orderstatus"]


@query(f"SELECT md5({row_text_sql(_ID_COLUMNS)}) AS U_ID, o_orderkey, o_custkey, o_orderstatus FROM orders")
def row_ids(spark: SparkSession, folder: str) -> DataFrame:
    return with_row_id(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), True)


@query("SELECT count(*) AS n_rows, count(*) AS n_ids FROM events")
def random_row_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "ids")
    write_table(with_row_id(table(spark, folder, "events")), path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("U_ID").alias("n_ids"))


_CHECK_SHAPE = """SELECT check_type, source_count, target_count, sample_size, matching_rows, accuracy_percentage, status FROM (
  SELECT 'ROW_COUNT' AS check_type, n AS source_count, n AS target_count, CAST(NULL AS BIGINT) AS sample_size, CAST(NULL AS BIGINT) AS matching_rows,
    100.0::DOUBLE AS accuracy_percentage, 'PASSED' AS status FROM (SELECT count(*) AS n FROM orders)
  UNION ALL SELECT 'CONTENT_ACCURACY', n, n, greatest(1, n // 10), greatest(1, n // 10), 100.0::DOUBLE, 'PASSED' FROM (SELECT count(*) AS n FROM orders))"""


@query(_CHECK_SHAPE)
def orders_arrived(spark: SparkSession, folder: str) -> DataFrame:
    """Flagship: orders read as text, dates normalised, cleaned, written, reconciled."""
    spec = {
        "source_type": "parquet",
        "source_file_path": "orders.parquet",
        "source_options": {"decimals": {"o_totalprice": 2}},
        "target_table": "ORDERS",
        "primary_key": ["O_ORDERKEY"],
    }
    run = run_table(spark, spec, folder, scratch_dir(spark, "orders"))
    checks = spark.createDataFrame([tuple(r) for r in run.checks], CHECK_SCHEMA)
    return checks.drop("table_name", "error_message")


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, lower(o_orderstatus) AS status_now,
      strftime(o_orderdate, '%m/%d/%Y') AS placed_on, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS priority FROM orders"""
)
def table_run(spark: SparkSession, folder: str) -> DataFrame:
    """One table from delimited files to the written result."""
    base = scratch_dir(spark, "run")
    sql = """SELECT o_orderkey AS `order id`, '  ' || o_orderstatus AS `status-now`, date_format(o_orderdate, 'yyyy-MM-dd') AS `placed_on`,
      CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' ELSE o_orderpriority END AS priority FROM orders"""
    write_table(from_sql(spark, folder, sql, "orders"), f"{base}/in/orders", fmt="csv", header=True, ignoreLeadingWhiteSpace=False)
    spec = {
        "source_type": "csv",
        "source_file_path": "in/orders",
        "target_table": "ORDERS",
        "primary_key": ["ORDER ID"],
        "data_quality_checks": {"sample_percentage": 20.0},
    }
    cleaning = CleaningOptions(null_strategy="fill_default", operations=[{"column": "status-now", "operation": "lower"}])
    run_table(spark, spec, base, f"{base}/out", cleaning=cleaning)
    return spark.read.parquet(f"{base}/out/ORDERS")


def _table_specs() -> dict[str, dict]:
    kept = {"target_type": "parquet", "source_type": "parquet"}
    return {
        "orders": {**kept, "source_file_path": "orders.parquet", "target_table": "ORDERS", "primary_key": ["o_orderkey"]},
        "lines": {**kept, "source_file_path": "lineitem.parquet", "target_table": "LINES", "primary_key": ["l_orderkey", "l_linenumber"]},
        "two": {**kept, "source_file_path": ["customer.parquet", "supplier.parquet"], "target_table": "PARTIES"},
        "gone": {**kept, "source_file_path": ["customer.parquet", "missing.parquet"], "target_table": "GONE"},
        "keyless": {**kept, "source_file_path": "part.parquet", "target_table": "KEYLESS", "primary_key": ["no_such_column"]},
    }


_REPORT = """WITH r AS (
    SELECT 'ORDERS' AS table_name, TRUE AS loaded, TRUE AS quality_passed, CAST(0 AS BIGINT) AS violations, count(*) AS total_rows FROM orders
    UNION ALL SELECT 'LINES', TRUE, TRUE, (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), count(*) FROM lineitem
    UNION ALL SELECT 'PARTIES', TRUE, TRUE, 0, (SELECT count(*) FROM customer) + (SELECT count(*) FROM supplier)
    UNION ALL SELECT 'GONE', FALSE, FALSE, NULL, 0 UNION ALL SELECT 'KEYLESS', FALSE, FALSE, NULL, 0)"""


@query(_REPORT + " SELECT * FROM r")
def tables_report(spark: SparkSession, folder: str) -> DataFrame:
    """Five tables, two of which cannot load; the others do."""
    runs = run_tables(spark, _table_specs(), folder, scratch_dir(spark, "tables"), parallel=3)
    return run_report(spark, runs).select("table_name", "loaded", "quality_passed", "violations", "total_rows")


@query(
    _REPORT
    + """ SELECT count(*) AS tables, count(*) FILTER (loaded) AS succeeded, count(*) FILTER (NOT loaded) AS failed,
      count(*) FILTER (quality_passed) AS quality_passed, CAST(sum(total_rows) AS BIGINT) AS total_rows FROM r"""
)
def tables_summary(spark: SparkSession, folder: str) -> DataFrame:
    runs = run_tables(spark, _table_specs(), folder, scratch_dir(spark, "tables"), parallel=3)
    return run_summary(run_report(spark, runs))


@query(
    """SELECT o_orderstatus AS status, CAST(count(*) AS VARCHAR) AS n_orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey < 10 GROUP BY o_orderstatus"""
)
def sql_file_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run whose source is a SQL file over two aliased files."""
    base = scratch_dir(spark, "sqlrun")
    sql = """SELECT o_orderstatus AS status, CAST(count(*) AS STRING) AS n_orders,
      CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS STRING) AS total
      FROM placed JOIN people ON o_custkey = c_custkey WHERE CAST(c_nationkey AS INT) < 10 GROUP BY o_orderstatus;"""
    spark.createDataFrame([(sql,)], "value string").coalesce(1).write.text(f"{base}/report.sql")
    spec = {
        "source_type": "custom_query",
        "custom_query": f"{base}/report.sql",
        "data_source": {
            "type": "parquet",
            "file_path": ["orders.parquet", "customer.parquet"],
            "table_alias": ["placed", "people"],
            "options": {"decimals": {}},
        },
        "target_table": "SUMMARY",
        "target_type": "csv",
    }
    run_table(spark, spec, folder, f"{base}/out")
    return read_delimited(spark, f"{base}/out/SUMMARY")
