"""Names, text, dates, column operations, null handling, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.dates import COLUMN_PATTERNS
from tideline.functions.names import clean_headers, trim_headers
from tideline.functions.text import NULL_WORDS, blank_to_null, homogenize, nested_to_text, trim_strings
from tideline.operators.datetimes import datetime_profile, normalize_datetimes
from tideline.operators.transform import CleaningOptions, apply_operations, clean_table, dedupe, handle_nulls
from tideline.suite.registry import from_sql, query, table

# The tokens and words that mean nothing is there.
TOKEN_CASE = """CASE o_orderkey % 9 WHEN 0 THEN 'NULL' WHEN 1 THEN 'null' WHEN 2 THEN 'NA' WHEN 3 THEN 'N/A'
  WHEN 4 THEN 'n/a' WHEN 5 THEN '' WHEN 6 THEN 'Na' ELSE o_orderpriority END"""
# The tokens and words that mean nothing is there.
WORD_CASE = """CASE o_orderkey % 9 WHEN 0 THEN 'nan' WHEN 1 THEN 'NaN' WHEN 2 THEN '<NA>' WHEN 3 THEN 'None'
  WHEN 4 THEN 'null' WHEN 5 THEN 'NULL' WHEN 6 THEN 'none' ELSE o_orderstatus END"""


@query(
    f"""SELECT o_orderkey,
      CASE WHEN tok IN ('', 'NULL', 'null', 'NA', 'N/A', 'n/a') THEN NULL ELSE tok END AS token,
      CASE WHEN word IN ('nan', 'NaN', '<NA>', 'None', 'null', 'NULL') THEN NULL ELSE word END AS word
    FROM (SELECT o_orderkey, {TOKEN_CASE} AS tok, {WORD_CASE} AS word FROM orders)"""
)
def null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    df = orders.select("o_orderkey", F.expr(TOKEN_CASE).alias("token"), F.expr(WORD_CASE).alias("word"))
    return blank_to_null(blank_to_null(df, columns=["token"]), NULL_WORDS, ["word"])


@query(
    """SELECT o_orderkey AS order_id, o_custkey AS COL_2nd_key, o_orderstatus AS TABLE_COL, o_orderpriority AS date_COL,
      o_orderkey AS a_b, o_custkey AS a_b_1, o_orderkey AS UNNAMED_COLUMN,
      o_custkey AS a_rather_long_heading_that__01, o_orderkey AS a_rather_long_heading_that__02
    FROM orders"""
)
def sanitize_headers(spark: SparkSession, folder: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    dirty = table(spark, folder, "orders").select(
        k.alias(" order id "), c.alias("2nd--key"), F.col("o_orderstatus").alias("TABLE"),
        F.col("o_orderpriority").alias("__date__"), k.alias("a-b"), c.alias("a b"), k.alias("()"),
        c.alias("a rather long heading that ends in one"), k.alias("a rather long heading that ends in two"),
    )
    return clean_headers(trim_headers(dirty))[0]


# One text column per shape the detector must tell apart.
DATE_TEXTS = """
  SELECT o_orderkey,
    strf(o_orderdate, '{iso_time}') AS updated,
    CASE WHEN o_orderkey % 3 = 0 THEN ' ' || strf(o_orderdate, '{slash}') || ' '
         WHEN o_orderkey % 101 = 0 THEN 'unknown' ELSE strf(o_orderdate, '{slash}') END AS note,
    strf(o_orderdate, '{compact}') AS ship_date,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE strf(o_orderdate, '{euro}') END AS due,
    strf(o_orderdate, '{compact}') AS code,
    o_orderpriority AS option_only, o_orderstatus
  FROM orders
"""
_SPARK_DATES = {"iso_time": "yyyy-MM-dd HH:mm:ss", "slash": "MM/dd/yyyy", "compact": "yyyyMMdd", "euro": "dd/MM/yyyy"}
_SQL_DATES = {"iso_time": "%Y-%m-%d %H:%M:%S", "slash": "%m/%d/%Y", "compact": "%Y%m%d", "euro": "%d/%m/%Y"}
DATE_TEXTS_SQL = DATE_TEXTS.format(**_SQL_DATES).replace("strf(", "strftime(")

# The column patterns in the other engine's notation.
_SQL_PATTERNS = {
    "iso_fraction": ["%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%d %H:%M:%S"],
    "iso_seconds": ["%Y-%m-%d %H:%M:%S"],
    "iso_date": ["%Y-%m-%d"],
    "month_first_fraction": ["%m/%d/%Y %H:%M:%S.%f", "%m/%d/%Y %H:%M:%S"],
    "month_first_seconds": ["%m/%d/%Y %H:%M:%S"],
    "month_first_date": ["%m/%d/%Y"],
    "day_first_date": ["%d/%m/%Y"],
    "compact_date": ["%Y%m%d"],
}


def _parsed_sql(column: str, pattern: str) -> str:
    return "COALESCE(" + ", ".join(f"try_strptime(trim({column}), '{f}')" for f in _SQL_PATTERNS[pattern]) + ")"


def _detect_sql(column: str, by_name: bool) -> str:
    looks = f"length(trim({column})) >= 8 AND regexp_matches({column}, '[0-9]') AND regexp_matches(trim({column}), '[-/ :]')"
    counts = ", ".join(f"count({_parsed_sql(column, p.name)}) AS p{k}" for k, p in enumerate(COLUMN_PATTERNS))
    flagged = "TRUE" if by_name else "looks"
    first = " ".join(f"WHEN {flagged} AND p{k} > 0 THEN '{p.name}'" for k, p in enumerate(COLUMN_PATTERNS))
    number = " ".join(f"WHEN {flagged} AND p{k} > 0 THEN p{k}" for k in range(len(COLUMN_PATTERNS)))
    return f"""SELECT '{column}' AS column_name, {str(by_name).upper()} AS flagged_by_name, looks AS flagged_by_content,
      CASE {first} END AS pattern, n AS non_null_count, CASE {number} ELSE 0 END AS parsed_count,
      CASE WHEN {flagged} THEN n - CASE {number} ELSE 0 END ELSE 0 END AS unparsed_count
      FROM (SELECT count({column}) AS n, COALESCE(bool_or({looks}), FALSE) AS looks, {counts} FROM d)"""


_DETECT_COLUMNS = {"updated": True, "note": False, "ship_date": True, "due": False, "code": False, "option_only": True, "o_orderstatus": False}


def date_texts(spark: SparkSession, folder: str) -> DataFrame:
    sql = DATE_TEXTS.format(**_SPARK_DATES).replace("strf(", "date_format(")
    return from_sql(spark, folder, sql, "orders")


@query(f"WITH d AS ({DATE_TEXTS_SQL}) " + " UNION ALL ".join(_detect_sql(c, n) for c, n in _DETECT_COLUMNS.items()))
def datetime_detect(spark: SparkSession, folder: str) -> DataFrame:
    return datetime_profile(date_texts(spark, folder))


@query(
    f"""WITH d AS ({DATE_TEXTS_SQL}) SELECT o_orderkey,
      strftime(try_strptime(updated, '%Y-%m-%d %H:%M:%S'), '%m/%d/%Y %I:%M %p') AS updated,
      strftime(try_strptime(trim(note), '%m/%d/%Y'), '%m/%d/%Y') AS note,
      strftime(try_strptime(ship_date, '%Y%m%d'), '%m/%d/%Y') AS ship_date,
      strftime(try_strptime(due, '%m/%d/%Y'), '%m/%d/%Y') AS due, code, option_only, o_orderstatus FROM d"""
)
def datetime_normalize(spark: SparkSession, folder: str) -> DataFrame:
    return normalize_datetimes(date_texts(spark, folder))


@query(
    """SELECT event_id, strftime(ts, '%m/%d/%Y %I:%M %p') AS ts, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS exact,
      event_type, props FROM events"""
)
def datetime_typed(spark: SparkSession, folder: str) -> DataFrame:
    """Typed timestamps are rewritten as text with the full value kept beside it."""
    events = table(spark, folder, "events").select("event_id", "ts", "event_type", "props")
    kept = normalize_datetimes(events, keep_typed=True)
    return kept.select(
        "event_id", "ts", F.date_format("ts__ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("exact"), "event_type", "props"
    )


PADDED = """SELECT p_partkey, '  ' || p_name || chr(9) AS p_name, chr(10) || ' ' || p_brand AS p_brand,
  p_type || chr(160) AS p_type, p_size FROM part"""


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part")
def trim_strings_all(spark: SparkSession, folder: str) -> DataFrame:
    return trim_strings(from_sql(spark, folder, PADDED, "part"))


@query("SELECT p_partkey, upper(p_name) AS p_name, lower(p_brand) AS p_brand, lower(upper(p_type)) AS p_type FROM part")
def upper_lower(spark: SparkSession, folder: str) -> DataFrame:
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return apply_operations(
        part,
        [
            {"column": "p_name", "operation": "upper"},
            {"column": "p_brand", "operation": "lower"},
            {"column": "p_type", "operation": "upper"},
            {"column": "p_type", "operation": "lower"},
        ],
    )


@query(
    r"""SELECT c_custkey, regexp_replace(c_name, '([A-Za-z]+)#0*([0-9])', '\1 no. \2', 'g') AS c_name,
      regexp_replace(c_mktsegment, '[AEIOU]', '_', 'g') AS c_mktsegment FROM customer"""
)
def replace_regex(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return apply_operations(
        customer,
        [
            {"column": "c_name", "operation": "replace", "params": {"old": "([A-Za-z]+)#0*([0-9])", "new": "$1 no. $2"}},
            {"column": "c_mktsegment", "operation": "replace", "params": {"old": "[AEIOU]", "new": "_"}},
        ],
    )


CAST_TEXTS = """SELECT o_orderkey,
  CASE o_orderkey % 5 WHEN 0 THEN 'n/k' WHEN 1 THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS customer,
  CASE o_orderkey % 7 WHEN 0 THEN 'free' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price
  FROM orders"""


@query(f"SELECT o_orderkey, TRY_CAST(customer AS BIGINT) AS customer, TRY_CAST(price AS DOUBLE) AS price FROM ({CAST_TEXTS})")
def cast_lenient(spark: SparkSession, folder: str) -> DataFrame:
    return apply_operations(
        from_sql(spark, folder, CAST_TEXTS, "orders"),
        [
            {"column": "customer", "operation": "cast", "params": {"type": "bigint"}},
            {"column": "price", "operation": "cast", "params": {"type": "double"}},
        ],
    )


# Customers with and without orders: NULLs of every type.
SPARSE = """SELECT c_custkey, c_name, o_orderkey, o_totalprice, o_orderstatus, o_orderstatus = 'F' AS finished, o_orderdate
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderkey % 2 = 0"""


@query(
    f"""SELECT c_custkey, c_name, COALESCE(o_orderkey, 0) AS o_orderkey, COALESCE(o_totalprice, 0.0) AS o_totalprice,
      COALESCE(o_orderstatus, '') AS o_orderstatus, COALESCE(finished, FALSE) AS finished, o_orderdate FROM ({SPARSE})"""
)
def null_fill(spark: SparkSession, folder: str) -> DataFrame:
    return handle_nulls(from_sql(spark, folder, SPARSE, "customer", "orders"), "fill_default")


@query(f"SELECT * FROM ({SPARSE}) WHERE o_orderkey IS NOT NULL")
def null_drop(spark: SparkSession, folder: str) -> DataFrame:
    return handle_nulls(from_sql(spark, folder, SPARSE, "customer", "orders"), "drop_rows")


@query(
    """SELECT o_orderkey,
      '{"key":' || o_orderkey || ',"status":"' || o_orderstatus || '","who":{"id":' || o_custkey || '}}' AS doc,
      '[' || o_orderkey || ',' || o_custkey || ']' AS pair,
      '{"' || o_orderstatus || '":' || o_custkey || '}' AS lookup FROM orders"""
)
def nested_to_string(spark: SparkSession, folder: str) -> DataFrame:
    k, c, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    nested = table(spark, folder, "orders").select(
        k,
        F.struct(k.alias("key"), s.alias("status"), F.struct(c.alias("id")).alias("who")).alias("doc"),
        F.array(k, c).alias("pair"),
        F.create_map(s, c).alias("lookup"),
    )
    return nested_to_text(nested)


@query(
    """SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000) AS BIGINT)), ',') || ']'
      AS embedding, label FROM embeddings"""
)
def vectors_to_string(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1000))
    return nested_to_text(vectors.withColumn("embedding", whole))


RECORDS = """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE ' ' || c_name END AS name,
    CAST(NULL AS VARCHAR) AS city, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer
  UNION ALL SELECT s_suppkey, s_name || ' ', CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE 'Port' END, NULL FROM supplier"""


@query(
    f"""SELECT CAST(id AS VARCHAR) AS id, nullif(trim(name), '') AS name, nullif(trim(city), '') AS city,
      CAST(balance AS VARCHAR) AS balance FROM ({RECORDS})"""
)
def homogenize_records(spark: SparkSession, folder: str) -> DataFrame:
    return homogenize(from_sql(spark, folder, RECORDS, "customer", "supplier"))


@query("SELECT DISTINCT l_partkey, l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem")
def dedupe_all(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return dedupe(lines.select("l_partkey", "l_returnflag", "l_linestatus", "l_quantity", "l_discount"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn = 1"""
)
def dedupe_subset(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    order = [F.col("l_shipdate").desc(), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_quantity")]
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]
    return dedupe(lines.select(*columns), ["L_ORDERKEY", "L_LINENUMBER"], order)


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedupe_any_survivor(spark: SparkSession, folder: str) -> DataFrame:
    """Which row of a key survives is open, so only the keys are shown."""
    return dedupe(table(spark, folder, "events"), ["user_id", "event_type"]).select("user_id", "event_type")


@query(
    """SELECT DISTINCT o_orderkey AS order_id, lower(o_orderstatus) AS state_now,
      regexp_replace(o_orderpriority, '^[0-9]-', '') AS ORDER_COL,
      CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE o_custkey END AS customer,
      '[' || o_orderkey || ']' AS keys FROM orders"""
)
def transform_chain(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cleaning chain, duplicates included."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order id"),
        F.concat(F.lit("  "), "o_orderstatus").alias("state-now"),
        F.col("o_orderpriority").alias("ORDER"),
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_custkey")).alias(" customer"),
        F.array("o_orderkey").alias("keys"),
    )
    options = CleaningOptions(
        null_strategy="fill_default",
        operations=[
            {"column": "state-now", "operation": "lower"},
            {"column": "ORDER", "operation": "replace", "params": {"old": "^[0-9]-", "new": ""}},
        ],
        remove_duplicates=True,
    )
    return clean_table(orders.unionAll(orders), options)[0]
