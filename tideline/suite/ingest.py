"""Reading: delimited, fixed-width, typed, many files, SQL over sources, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.names import col
from tideline.session import scratch_dir
from tideline.sinks.fixed_width import overflows, write_dbf, write_fixed_text
from tideline.sinks.tables import write_table
from tideline.sources.delimited import header_of, ragged_rows, read_delimited
from tideline.sources.fixed_width import Field, read_dbf, read_fixed_text
from tideline.sources.many import read_delimited_files, read_typed_files
from tideline.sources.sql import run_sql
from tideline.sources.typed import read_typed_as_text
from tideline.streaming.ingest import append_stream, for_each_batch, stream_files
from tideline.suite.registry import from_sql, query, table

# Order lines as they might come by file: short, long, with null tokens, quoted.
_LINE = '''CASE o_orderkey % 10
  WHEN 3 THEN concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus)
  WHEN 5 THEN concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus, 'N/A', o_orderpriority)
  WHEN 6 THEN concat_ws(',', CAST(o_orderkey AS VARCHAR), '""', CAST(o_custkey AS VARCHAR), 'NULL')
  WHEN 7 THEN concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(o_custkey AS VARCHAR), o_orderpriority, 'extra', 'more')
  WHEN 8 THEN concat_ws(',', CAST(o_orderkey AS VARCHAR), '"a, quoted ""text"""', CAST(o_custkey AS VARCHAR), o_orderpriority)
  ELSE concat_ws(',', CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(o_custkey AS VARCHAR), o_orderpriority) END'''
_HEADER = "order_id,status,customer,priority"


def ragged_files(spark: SparkSession, folder: str) -> str:
    """Delimited files with a header line each, derived from all orders."""
    path = scratch_dir(spark, "ragged")
    lines = from_sql(spark, folder, f"SELECT {_LINE} AS `{_HEADER}` FROM orders", "orders")
    lines.write.option("header", True).option("sep", "\x01").option("quote", "").option("escape", "").csv(path)
    return path


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
      CASE o_orderkey % 10 WHEN 6 THEN NULL WHEN 8 THEN 'a, quoted "text"' ELSE o_orderstatus END AS status,
      CASE WHEN o_orderkey % 10 IN (3, 5) THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS customer,
      CASE WHEN o_orderkey % 10 IN (3, 6) THEN NULL ELSE o_orderpriority END AS priority FROM orders"""
)
def csv_lenient(spark: SparkSession, folder: str) -> DataFrame:
    return read_delimited(spark, ragged_files(spark, folder), reader={"escape": '"'})


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS order_id, {_LINE} AS raw FROM orders WHERE o_orderkey % 10 IN (3, 7)")
def csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    df = read_delimited(spark, ragged_files(spark, folder), keep_corrupt=True, reader={"escape": '"'})
    return ragged_rows(df).select("order_id", F.col("_corrupt_record").alias("raw"))


# Short names: a dBASE field name has ten characters at most.
_FIXED = """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
  CASE WHEN o_orderkey % 5 = 0 THEN '00' || CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END AS code,
  o_orderstatus = 'F' AS done, o_orderdate AS placed, CASE WHEN o_orderkey % 3 = 0 THEN 'Café Zürich' ELSE 'plain' END AS place FROM orders"""
_FIXED_SQL = f"""SELECT CAST(id AS VARCHAR) AS id,
  CASE WHEN price = floor(price) THEN CAST(CAST(price AS BIGINT) AS VARCHAR) ELSE CAST(CAST(price AS DECIMAL(15,2)) AS VARCHAR) END AS price,
  code, CASE WHEN done THEN 'True' ELSE 'False' END AS done, strftime(placed, '%Y-%m-%d') AS placed, place FROM ({_FIXED})"""


@query(_FIXED_SQL)
def fixed_width_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "fixed")
    fields = write_fixed_text(from_sql(spark, folder, _FIXED, "orders"), path)
    return read_fixed_text(spark, path, fields)


@query(_FIXED_SQL)
def dbf_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Binary tables in a legacy codepage, read back in record ranges."""
    path = scratch_dir(spark, "dbf")
    write_dbf(from_sql(spark, folder, _FIXED, "orders"), path)
    return read_dbf(spark, path)


@query(
    """SELECT 'text' AS field_name, CAST(n AS BIGINT) AS n_values FROM (SELECT count(*) AS n FROM documents WHERE length(text) > 100)
    UNION ALL SELECT 'doc_id', count(*) FROM documents WHERE doc_id > 99 HAVING count(*) > 0"""
)
def fixed_width_overflow(spark: SparkSession, folder: str) -> DataFrame:
    """Values a fixed-width write would have to cut."""
    fields = [Field("doc_id", "N", 2), Field("text", "C", 100)]
    found = overflows(table(spark, folder, "documents"), fields)
    return found.groupBy("field_name").agg(F.count(F.lit(1)).alias("n_values"))


@query(
    """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS l_extendedprice, l_returnflag,
      strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem"""
)
def typed_scan_stringify(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"]
    return read_typed_as_text(spark, f"{folder}/lineitem.parquet", columns=columns, decimals={"l_extendedprice": 2})


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
      CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal, c_mktsegment, NULL AS s_suppkey, NULL AS s_name,
      NULL AS s_nationkey, NULL AS s_acctbal, 'customer.parquet' AS source_file FROM customer
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, CAST(s_suppkey AS VARCHAR), s_name, CAST(s_nationkey AS VARCHAR),
      CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS VARCHAR), 'supplier.parquet' FROM supplier"""
)
def multi_source_union(spark: SparkSession, folder: str) -> DataFrame:
    paths = [f"{folder}/customer.parquet", f"{folder}/supplier.parquet"]
    df = read_typed_files(spark, paths, decimals={"c_acctbal": 2, "s_acctbal": 2})
    return df.withColumnRenamed("_source_file", "source_file").withColumn("source_file", F.regexp_extract("source_file", "[^/]+$", 0))


_EVENT_FILES = ("SELECT event_id, event_type FROM events", "SELECT event_type, user_id, event_id FROM events", "SELECT event_id, event_type FROM events")


@query(
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, user_id, source FROM (
      SELECT event_id, event_type, CAST(user_id AS VARCHAR) AS user_id, 'b' AS source FROM events
      UNION ALL SELECT event_id, event_type, NULL, 'a' FROM events UNION ALL SELECT event_id, event_type, NULL, 'c' FROM events)"""
)
def uneven_csv_union(spark: SparkSession, folder: str) -> DataFrame:
    """Files whose headers differ; like headers share one scan."""
    base, paths = scratch_dir(spark, "uneven"), []
    for name, sql in zip("abc", _EVENT_FILES):
        paths.append(f"{base}/{name}")
        write_table(from_sql(spark, folder, sql, "events"), paths[-1], fmt="csv", header=True)
    df = read_delimited_files(spark, paths)
    return df.select("event_id", "event_type", "user_id", F.regexp_extract("_source_file", "/([abc])/[^/]+$", 1).alias("source"))


def event_files(spark: SparkSession, folder: str) -> tuple[str, list[str]]:
    path = scratch_dir(spark, "drop")
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"))
    events.repartition(4).write.option("header", True).csv(path)
    return path, header_of(spark, path)


_EVENT_TOTALS = """SELECT event_type, count(*) AS n_events, count(DISTINCT event_id) AS n_distinct,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY event_type"""


def _event_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.countDistinct("event_id").alias("n_distinct"),
        F.sum(F.col("value").try_cast("decimal(18,2)")).cast("double").alias("total"),
    )


@query(_EVENT_TOTALS)
def file_stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Files stream in two at a time; a second run finds nothing new to append."""
    files, names = event_files(spark, folder)
    target, checkpoint = scratch_dir(spark, "stream"), scratch_dir(spark, "stream-log")
    for _ in range(2):
        append_stream(stream_files(spark, files, names, files_per_batch=2), target, checkpoint, timeout=600)
    return _event_totals(spark.read.parquet(target))


@query(_EVENT_TOTALS)
def file_batches_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Each micro-batch runs a whole batch job and replaces its own folder."""
    files, names = event_files(spark, folder)
    target, checkpoint = scratch_dir(spark, "batches"), scratch_dir(spark, "batches-log")
    stream = stream_files(spark, files, names, files_per_batch=2)
    for_each_batch(stream, lambda batch: batch.distinct(), target, checkpoint, timeout=600)
    return _event_totals(spark.read.parquet(target))


REPORT = """SELECT o_orderpriority, l_returnflag, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS worth,
  COUNT(*) AS n_lines FROM shipped_lines JOIN placed_orders ON o_orderkey = l_orderkey
  WHERE l_shipdate >= TIMESTAMP '1997-01-01 00:00:00' GROUP BY o_orderpriority, l_returnflag"""


@query(REPORT.replace("shipped_lines", "lineitem").replace("placed_orders", "orders"))
def sql_alias_report(spark: SparkSession, folder: str) -> DataFrame:
    sources = {"shipped_lines": table(spark, folder, "lineitem"), "placed_orders": table(spark, folder, "orders")}
    return run_sql(spark, REPORT + ";", sources)


@query(
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier"""
)
def sql_multi_alias_union(spark: SparkSession, folder: str) -> DataFrame:
    one = table(spark, folder, "customer").select(col("c_custkey").alias("id "), col("c_name").alias("name"), col("c_nationkey").alias("nation"))
    two = table(spark, folder, "supplier").select(col("s_suppkey").alias("id"), col("s_name").alias("name"), col("s_nationkey").alias(" nation"))
    return run_sql(spark, "SELECT id, name, nation FROM buyers UNION ALL SELECT id, name, nation FROM sellers", {"buyers": one, "sellers": two})


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey < 0")
def sql_empty_result(spark: SparkSession, folder: str) -> DataFrame:
    """No rows, yet the columns and their types are there."""
    orders = table(spark, folder, "orders")
    return run_sql(spark, "SELECT o_orderkey, o_orderstatus FROM source_table WHERE o_orderkey < 0", {"source_table": orders})
