"""Reading what one task or one file at a time would not manage: cut quotes, many headers, mixed types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.date_shapes import datetime_shapes as shapes_of
from tideline.operators.date_shapes import rewrite_by_shape
from tideline.operators.rejects import REASONS, good_rows, rejected_rows
from tideline.session import scratch_dir
from tideline.sinks.tables import write_table
from tideline.sources.delimited import headers_of, read_delimited
from tideline.sources.many import file_sizes
from tideline.sources.relaxed import read_relaxed_files
from tideline.suite.registry import from_sql, query, table


@query("""SELECT CAST(doc_id AS VARCHAR) AS id, text || chr(10) || '"' || source || '",' AS text, n_chars::VARCHAR AS n_chars FROM documents""")
def csv_quoted_lines_split(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with line breaks and quotes, read in byte ranges."""
    path = scratch_dir(spark, "quoted-lines")
    text = F.concat("text", F.lit('\n"'), "source", F.lit('",')).alias("text")
    rows = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), text, "n_chars")
    write_table(rows, path, fmt="csv", header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_delimited(spark, path, null_tokens=(), reader={"multiLine": True})


@query(
    """SELECT 'id,name' AS header, count(*) AS n_rows FROM customer UNION ALL SELECT 'extra,name,id', count(*) FROM supplier
    UNION ALL SELECT 'region,"the, name"', count(*) FROM nation"""
)
def headers_of_folder(spark: SparkSession, folder: str) -> DataFrame:
    """The headers of a folder of many files, read by tasks, and how many rows each stands for."""
    path = scratch_dir(spark, "headers")
    by_nation = table(spark, folder, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_nationkey AS nation")
    by_nation.repartition(25, "nation").write.partitionBy("nation").option("header", True).csv(path)
    table(spark, folder, "supplier").selectExpr("'x' AS extra", "s_name AS name", "s_suppkey AS id").write.mode("append").csv(path, header=True)
    nations = table(spark, folder, "nation").selectExpr("n_regionkey AS region", "n_name AS `the, name`")
    nations.write.mode("append").csv(path, header=True)
    groups: dict[tuple, list[str]] = {}
    for file, names in headers_of(spark, file_sizes(spark, [path])).items():
        groups.setdefault(tuple(names), []).append(file)
    rows = [(",".join(f'"{n}"' if "," in n else n for n in names), read_delimited(spark, files, names=names).count()) for names, files in groups.items()]
    return spark.createDataFrame(rows, "header string, n_rows long")


# The same columns in five files, in another type each.
_MIXED = (
    "SELECT CAST(o_orderkey AS INT) AS id, CAST(o_custkey AS INT) AS amount, CAST(o_custkey AS INT) AS code, o_orderdate AS day FROM orders",
    "SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount, o_orderpriority AS code FROM orders",
    "SELECT CAST(o_orderkey AS SMALLINT) AS id, CAST(o_custkey AS BIGINT) AS amount, CAST(o_orderdate AS DATE) AS code FROM orders WHERE o_orderkey < 30000",
)
_MIXED_SQL = """SELECT CAST(o_orderkey AS BIGINT) AS id, CAST(CAST(o_custkey AS DECIMAL(21,2)) AS VARCHAR) AS amount, CAST(o_custkey AS VARCHAR) AS code,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS day, 0 AS file FROM orders
  UNION ALL SELECT CAST(o_orderkey AS BIGINT), CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(21,2)) AS VARCHAR), o_orderpriority, NULL, 1 FROM orders
  UNION ALL SELECT CAST(o_orderkey AS BIGINT), CAST(CAST(o_custkey AS DECIMAL(21,2)) AS VARCHAR), strftime(o_orderdate, '%Y-%m-%d'), NULL, 2 FROM orders WHERE o_orderkey < 30000"""


@query(_MIXED_SQL)
def typed_union_relaxed(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers, decimals, dates and text of one column meet in the least type that holds them all."""
    base = scratch_dir(spark, "relaxed")
    for k, sql in enumerate(_MIXED):
        write_table(from_sql(spark, folder, sql, "orders"), f"{base}/{k}")
    df = read_relaxed_files(spark, [f"{base}/{k}" for k in range(len(_MIXED))])
    day = F.date_format("day", "yyyy-MM-dd HH:mm:ss").alias("day")
    file = F.regexp_extract("_source_file", "/([0-9])/[^/]+$", 1).cast("int").alias("file")
    return df.select("id", F.col("amount").cast("string").alias("amount"), "code", day, file)


@query(
    """WITH d AS (SELECT 9007199254740992 + o_orderkey AS big FROM orders)
    SELECT 'good' AS outcome, CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT big FROM d WHERE big % 2 = 0 UNION ALL SELECT event_id FROM events)
    UNION ALL SELECT 'big:not_double', count(*) FROM d WHERE big % 2 = 1"""
)
def typed_union_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Whole numbers too large for a float beside floats: rows that would lose digits are rejected."""
    base = scratch_dir(spark, "lossy")
    write_table(table(spark, folder, "orders").select((F.lit(2**53) + F.col("o_orderkey")).alias("big")), f"{base}/long")
    write_table(table(spark, folder, "events").select(F.col("event_id").cast("double").alias("big")), f"{base}/double")
    both = read_relaxed_files(spark, [f"{base}/long", f"{base}/double"], on_loss="reject")
    good = good_rows(both).agg(F.lit("good").alias("outcome"), F.count("*").alias("n_rows"))
    return good.union(rejected_rows(both).groupBy(F.col(REASONS)).count())


_SHAPED = {"day_dot": "dd.MM.yyyy", "year_slash": "yyyy/MM/dd HH:mm", "month_first": "M/d/yyyy", "twelve_hours": "d-M-yyyy h:mm a", "solid": "yyyyMMddHHmmss"}


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%m/%d/%Y') AS day_dot, strftime(o_orderdate, '%m/%d/%Y %I:%M %p') AS year_slash,
      strftime(o_orderdate, '%m/%d/%Y') AS month_first, strftime(o_orderdate, '%m/%d/%Y %I:%M %p') AS twelve_hours,
      strftime(o_orderdate, '%m/%d/%Y %I:%M %p') AS solid, '1.2.3' AS release FROM orders"""
)
def datetime_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Dates in layouts that no list names, found by the shapes of their digits in one pass."""
    texts = ", ".join(f"date_format(o_orderdate, '{layout}') AS {name}" for name, layout in _SHAPED.items())
    df = from_sql(spark, folder, f"SELECT CAST(o_orderkey AS STRING) AS id, {texts}, '1.2.3' AS release FROM orders", "orders")
    return rewrite_by_shape(df, shapes_of(df))
