"""Key checks, samples and reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.constraints import (
    check_constraints,
    foreign_key_violations,
    primary_key_violations,
    unique_violations,
)
from tideline.operators.reconcile import (
    column_discrepancies,
    content_check,
    discrepancy_report,
    matched_rows,
    mismatched_rows,
    prepare_comparison,
    row_count_check,
    run_checks,
    side_samples,
)
from tideline.operators.sample import hash_sample
from tideline.session import scratch_dir
from tideline.sinks.history import append_history, read_history
from tideline.suite.registry import ORDER_COLUMNS, ORDER_COPY, ORDER_TEXT, from_sql, query, row_text_sql, table


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS n_rows, 'duplicate_key' AS violation
    FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
)
def pk_check(spark: SparkSession, folder: str) -> DataFrame:
    return primary_key_violations(table(spark, folder, "lineitem"), ["L_ORDERKEY", "l_linenumber"])


SPARSE_KEYS = "SELECT CASE WHEN user_id % 9 = 0 THEN NULL ELSE user_id END AS user_id, event_type FROM events"


@query(
    f"""SELECT user_id, event_type, count(*) AS n_rows, CASE WHEN user_id IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS violation
    FROM ({SPARSE_KEYS}) GROUP BY user_id, event_type HAVING count(*) > 1 OR user_id IS NULL"""
)
def pk_check_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """Keys with NULL parts, and keys that own a large share of the rows."""
    return primary_key_violations(from_sql(spark, folder, SPARSE_KEYS, "events"), ["user_id", "event_type"])


@query(
    f"""SELECT user_id, count(*) AS n_rows, 'duplicate_key' AS violation
    FROM ({SPARSE_KEYS}) WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1"""
)
def unique_check(spark: SparkSession, folder: str) -> DataFrame:
    return unique_violations(from_sql(spark, folder, SPARSE_KEYS, "events"), ["USER_ID"])


@query(
    """SELECT l_orderkey, count(*) AS n_rows, 'orphan_key' AS violation FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') GROUP BY l_orderkey"""
)
def fk_check(spark: SparkSession, folder: str) -> DataFrame:
    settled = table(spark, folder, "orders").filter(F.col("o_orderstatus") != "P")
    return foreign_key_violations(table(spark, folder, "lineitem"), ["l_orderkey"], settled, ["o_orderkey"])


@query(
    """SELECT 'primary_key' AS constraint_type, 'primary_key' AS constraint_name, '{"l_orderkey":' || l_orderkey || ',"l_linenumber":' || l_linenumber || '}' AS key_values,
      count(*) AS n_rows, 'duplicate_key' AS violation FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
    UNION ALL SELECT 'unique_index', 'one_part_per_order', '{"l_orderkey":' || l_orderkey || ',"l_partkey":' || l_partkey || '}', count(*), 'duplicate_key'
      FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1
    UNION ALL SELECT 'foreign_key', 'ORDERS', '{"l_orderkey":' || l_orderkey || '}', count(*), 'orphan_key' FROM lineitem
      WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus <> 'P') GROUP BY l_orderkey"""
)
def declared_constraints(spark: SparkSession, folder: str) -> DataFrame:
    spec = {
        "primary_key": ["L_OrderKey", "l_linenumber"],
        "indexes": [
            {"name": "one_part_per_order", "columns": ["l_orderkey", "l_partkey"], "unique": True},
            {"name": "by_date", "columns": ["l_shipdate"], "unique": False},
        ],
        "foreign_keys": [{"columns": ["l_orderkey"], "references_table": "ORDERS", "references_columns": ["o_orderkey"]}],
    }
    settled = table(spark, folder, "orders").filter(F.col("o_orderstatus") != "P")
    return check_constraints(table(spark, folder, "lineitem"), spec, {"orders": settled})


_CHECK = """SELECT 'ROW_COUNT' AS check_type, '{name}' AS table_name, s AS source_count, t AS target_count,
    CAST(NULL AS BIGINT) AS sample_size, CAST(NULL AS BIGINT) AS matching_rows,
    CASE WHEN s = t THEN 100.0::DOUBLE WHEN s = 0 THEN 0.0::DOUBLE ELSE round(100.0::DOUBLE * t / s, 2) END AS accuracy_percentage,
    CASE WHEN s = t THEN 'PASSED' ELSE 'FAILED' END AS status,
    CASE WHEN s <> t THEN CASE WHEN s > t THEN 'Missing ' ELSE 'Surplus ' END || abs(s - t) || ' rows (' ||
      printf('%.2f', round(100.0::DOUBLE * abs(s - t) / s, 2)) || '%)' END AS error_message"""


@query(_CHECK.format(name="ORDERS") + f" FROM (SELECT (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM ({ORDER_COPY})) AS t)")
def row_count_missing(spark: SparkSession, folder: str) -> DataFrame:
    return row_count_check(table(spark, folder, "orders"), from_sql(spark, folder, ORDER_COPY, "orders"), "ORDERS")


# A target fed from two files.
TWO_FILES = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 'north.csv' ELSE 'south.csv' END AS SOURCE_FILE FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, 'south.csv' FROM orders WHERE o_orderkey % 50 = 0"""


@query(
    _CHECK.format(name="ORDERS")
    + f""" FROM (SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 3 <> 0) AS s,
    (SELECT count(*) FROM ({TWO_FILES}) WHERE SOURCE_FILE = 'south.csv') AS t)"""
)
def row_count_by_file(spark: SparkSession, folder: str) -> DataFrame:
    source = table(spark, folder, "orders").filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_custkey")
    return row_count_check(source, from_sql(spark, folder, TWO_FILES, "orders"), "ORDERS", "south.csv")


@query(
    """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    ORDER BY sha256(CAST(length(CAST(o_orderkey AS VARCHAR)) AS VARCHAR) || ':' || CAST(o_orderkey AS VARCHAR))
    LIMIT (SELECT count(*) // 10 FROM orders)"""
)
def sample_by_hash(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return hash_sample(orders, orders.count() // 10, ["o_orderkey"])


@query(
    """SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n_rows FROM (
      SELECT l_returnflag, l_linestatus, l_linenumber FROM lineitem
      ORDER BY sha256('{"l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus || '","l_linenumber":' || l_linenumber || '}')
      LIMIT (SELECT count(*) // 3 FROM lineitem)) GROUP BY ALL"""
)
def sample_of_copies(spark: SparkSession, folder: str) -> DataFrame:
    """A sample of a table that holds few distinct rows very often."""
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")
    sample = hash_sample(lines, lines.count() // 3)
    return sample.groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(F.count(F.lit(1)).alias("n_rows"))


# The sample of the source, with the target's rows stripped, as plain SQL.
_SOURCE = f"SELECT *, sha256({row_text_sql(ORDER_COLUMNS)}) AS h FROM ({ORDER_TEXT})"
_TARGET = "SELECT " + ", ".join(f"trim({c}) AS {c}" for c in ORDER_COLUMNS) + f" FROM ({ORDER_COPY})"
_SAMPLE = f"""WITH src AS ({_SOURCE}), tgt AS ({_TARGET}),
  sample AS (SELECT * FROM src ORDER BY h LIMIT (SELECT greatest(1, least((SELECT count(*) FROM src), (SELECT count(*) FROM tgt)) // 10))),
  flagged AS (SELECT *, EXISTS (SELECT 1 FROM tgt WHERE """ + " AND ".join(
    f"tgt.{c} = sample.{c}" for c in ORDER_COLUMNS
) + ") AS found FROM sample)"
_CONTENT = """SELECT 'CONTENT_ACCURACY' AS check_type, '{name}' AS table_name, s AS source_count, t AS target_count, n AS sample_size,
    m AS matching_rows, round(100.0::DOUBLE * m / n, 2) AS accuracy_percentage, CASE WHEN m = n THEN 'PASSED' ELSE 'FAILED' END AS status,
    CASE WHEN m <> n THEN (n - m) || ' of ' || n || ' sampled rows are not in the target; the source has ' || s || ' rows, the target ' || t || '.' END
      AS error_message
  FROM (SELECT (SELECT count(*) FROM src) AS s, (SELECT count(*) FROM tgt) AS t, count(*) AS n, count(*) FILTER (found) AS m FROM flagged)"""


def compared_orders(spark: SparkSession, folder: str):
    source = from_sql(spark, folder, ORDER_TEXT, "orders")
    return prepare_comparison(source, from_sql(spark, folder, ORDER_COPY, "orders"), 10.0)


@query(_SAMPLE + " " + _CONTENT.format(name="ORDERS"))
def content_accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return content_check(compared_orders(spark, folder), "ORDERS")


@query(_SAMPLE + f" SELECT {', '.join(ORDER_COLUMNS)}, CAST(1 AS BIGINT) AS copies FROM flagged WHERE NOT found")
def content_mismatches(spark: SparkSession, folder: str) -> DataFrame:
    return mismatched_rows(compared_orders(spark, folder))


@query(_SAMPLE + f" SELECT {', '.join(ORDER_COLUMNS)}, CAST(1 AS BIGINT) AS copies FROM flagged WHERE found")
def content_matches(spark: SparkSession, folder: str) -> DataFrame:
    return matched_rows(compared_orders(spark, folder))


# Few distinct rows with many copies; the target lost some copies of one of them.
COPIES = "SELECT l_returnflag, l_linestatus, CAST(l_linenumber AS VARCHAR) AS line FROM lineitem"
FEWER = COPIES + " WHERE NOT (l_linenumber = 3 AND l_returnflag = 'A' AND l_orderkey % 2 = 0)"


@query(
    f"""WITH src AS ({COPIES}), tgt AS ({FEWER}), counts AS (
      SELECT s.n, COALESCE(t.n, 0) AS k FROM (SELECT *, count(*) AS n FROM src GROUP BY ALL) s
      LEFT JOIN (SELECT *, count(*) AS n FROM tgt GROUP BY ALL) t USING (l_returnflag, l_linestatus, line)),
      totals AS (SELECT CAST(sum(n) AS BIGINT) AS s, (SELECT count(*) FROM tgt) AS t, CAST(sum(least(n, k)) AS BIGINT) AS m FROM counts)
    SELECT 'CONTENT_ACCURACY' AS check_type, 'LINES' AS table_name, s AS source_count, t AS target_count, s AS sample_size, m AS matching_rows,
      round(100.0::DOUBLE * m / s, 2) AS accuracy_percentage, CASE WHEN m = s THEN 'PASSED' ELSE 'FAILED' END AS status,
      CASE WHEN m <> s THEN (s - m) || ' of ' || s || ' sampled rows are not in the target; the source has ' || s || ' rows, the target ' || t || '.' END
        AS error_message FROM totals"""
)
def content_with_copies(spark: SparkSession, folder: str) -> DataFrame:
    """All rows compared, copies counted.  The percentage is above 100 so that losing rows leaves no sampling."""
    source, target = from_sql(spark, folder, COPIES, "lineitem"), from_sql(spark, folder, FEWER, "lineitem")
    return content_check(prepare_comparison(source, target, 1000.0), "LINES", count_copies=True)


_SCORE = " + ".join(f"CAST(m.{c} = tgt.{c} AS INTEGER)" for c in ORDER_COLUMNS)
_BEST = (
    _SAMPLE
    + f""", placed AS (SELECT *, row_number() OVER (ORDER BY h) AS row_index FROM flagged),
  missing AS (SELECT * FROM placed WHERE NOT found ORDER BY h LIMIT 5),
  ranked AS (SELECT m.row_index, {", ".join(f"m.{c} AS s_{c}, tgt.{c} AS t_{c}" for c in ORDER_COLUMNS)}, {_SCORE} AS score,
    row_number() OVER (PARTITION BY m.row_index ORDER BY {_SCORE} DESC, {", ".join("tgt." + c for c in ORDER_COLUMNS)}) AS rn
    FROM missing m CROSS JOIN tgt) """
    + " UNION ALL ".join(
        f"SELECT row_index, '{c}' AS column_name, s_{c} AS source_value, t_{c} AS target_value, score AS matched_columns, 5 AS compared_columns FROM ranked WHERE rn = 1"
        for c in ORDER_COLUMNS[:3]
    )
)


@query(_BEST)
def best_match(spark: SparkSession, folder: str) -> DataFrame:
    return discrepancy_report(compared_orders(spark, folder))


_FIRST = ", ".join(
    f"p{side} AS (SELECT *, row_number() OVER (ORDER BY h) AS place, count(*) OVER () - 3 AS more_rows FROM (SELECT *, sha256({row_text_sql(ORDER_COLUMNS)}) AS h FROM {name}))"
    for side, name in (("source", "src"), ("target", "tgt"))
)


@query(
    f"WITH src AS ({ORDER_TEXT}), tgt AS ({_TARGET}), {_FIRST} "
    + " UNION ALL ".join(
        f"SELECT '{side}' AS side, place, '{c}' AS column_name, {c} AS value, more_rows FROM p{side} WHERE place <= 3" for side in ("source", "target") for c in ORDER_COLUMNS[:3]
    )
)
def mismatch_samples(spark: SparkSession, folder: str) -> DataFrame:
    """What a failed check shows of both sides, and how much it leaves out."""
    return side_samples(compared_orders(spark, folder))


_SIDES = ["o_custkey", "o_orderstatus", "o_orderpriority"]


def _column_sql(c: str) -> str:
    one_sided = "(SELECT COALESCE(string_agg(v, ', ' ORDER BY v), '') FROM (SELECT v FROM j{i} WHERE {side} = 0 ORDER BY v LIMIT 3))"
    i = _SIDES.index(c)
    return f"""SELECT '{c}' AS column_name, CAST(sum(s) AS BIGINT) AS source_distinct, CAST(sum(t) AS BIGINT) AS target_distinct,
      count(*) FILTER (s = 1 AND t = 1) AS common_values, count(*) FILTER (t = 0) AS source_only, count(*) FILTER (s = 0) AS target_only,
      {one_sided.format(i=i, side='t')} AS source_only_examples, {one_sided.format(i=i, side='s')} AS target_only_examples FROM j{i}"""


_SIDE_CTES = ", ".join(
    f"""j{i} AS (SELECT COALESCE(a.v, b.v) AS v, CAST(a.v IS NOT NULL AS INTEGER) AS s, CAST(b.v IS NOT NULL AS INTEGER) AS t
    FROM (SELECT DISTINCT {c} AS v FROM src) a FULL JOIN (SELECT DISTINCT {c} AS v FROM tgt) b ON a.v = b.v)"""
    for i, c in enumerate(_SIDES)
)
_DIVERGED = """SELECT CASE WHEN o_custkey % 50 = 7 THEN 'C' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
  CASE WHEN o_orderstatus = 'P' THEN 'pending' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority FROM orders"""


@query(f"WITH src AS ({ORDER_TEXT}), tgt AS ({_DIVERGED}), {_SIDE_CTES} " + " UNION ALL ".join(_column_sql(c) for c in _SIDES))
def column_discrepancy(spark: SparkSession, folder: str) -> DataFrame:
    source, target = from_sql(spark, folder, ORDER_TEXT, "orders"), from_sql(spark, folder, _DIVERGED, "orders")
    return column_discrepancies(source, target, _SIDES)


_FIELDS = (
    "TABLE_NAME", "CHECK_TYPE", "SOURCE_COUNT", "TARGET_COUNT", "SAMPLE_SIZE", "MATCHING_ROWS", "ACCURACY_PERCENTAGE", "STATUS", "ERROR_MESSAGE",
)
_STORED = ", ".join(f"CAST({f.lower()} AS DOUBLE) AS {f}" if f == "ACCURACY_PERCENTAGE" else f"{f.lower()} AS {f}" for f in _FIELDS)


@query(
    _SAMPLE
    + f" SELECT {_STORED} FROM ({_CHECK.format(name='ORDERS')} FROM (SELECT (SELECT count(*) FROM src) AS s, (SELECT count(*) FROM tgt) AS t)) UNION ALL SELECT {_STORED} FROM ("
    + _CONTENT.format(name="ORDERS")
    + ")"
)
def quality_history(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of two tables stored, one table's report read back."""
    path = scratch_dir(spark, "history")
    source = from_sql(spark, folder, ORDER_TEXT, "orders")
    append_history(run_checks(source, from_sql(spark, folder, ORDER_COPY, "orders"), "ORDERS", details=False), path)
    append_history(run_checks(source, source, "ORDERS_SAME", content=False), path)
    history = read_history(spark, path, "ORDERS")
    return history.select(*[F.col(f).cast("double").alias(f) if f == "ACCURACY_PERCENTAGE" else F.col(f) for f in _FIELDS])


@query(
    """SELECT 'CONTENT_ACCURACY' AS check_type, name AS table_name, s AS source_count, t AS target_count, 'FAILED' AS status, message AS error_message FROM (
      SELECT 'EMPTY_SOURCE' AS name, CAST(0 AS BIGINT) AS s, (SELECT count(*) FROM orders) AS t, 'the source side has no rows' AS message
      UNION ALL SELECT 'EMPTY_TARGET', (SELECT count(*) FROM orders), 0, 'the target side has no rows'
      UNION ALL SELECT 'NOTHING_COMMON', NULL, NULL,
        'the two sides share no column to compare (left out: U_ID, SOURCE_FILE)')"""
)
def content_refusals(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = table(spark, folder, "orders"), table(spark, folder, "customer")
    none = orders.filter("o_orderkey < 0")
    pairs = {"EMPTY_SOURCE": (none, orders), "EMPTY_TARGET": (orders, none), "NOTHING_COMMON": (orders, customer)}
    rows = [run_checks(s, t, name, row_count=False) for name, (s, t) in pairs.items()]
    found = reduce(DataFrame.unionAll, rows)
    return found.select("check_type", "table_name", "source_count", "target_count", "status", "error_message")
