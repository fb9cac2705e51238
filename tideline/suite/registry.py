"""Where queries register, and what they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideline.session import configure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if it has one."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# SQL that mirrors the library's text forms.


def row_text_sql(columns: list[str]) -> str:
    """Each value after its length, as the row hash reads it."""
    return " || ".join(f"CAST(length({c}) AS VARCHAR) || ':' || {c}" for c in columns)


# Orders as text, and a copy of it that lost and changed rows: both sides of the
# reconciliation queries.  Money is text with two digits.
ORDER_TEXT = """
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
         o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice, o_orderpriority
  FROM orders
"""
ORDER_COPY = """
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
         CASE WHEN o_orderkey % 89 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
         CASE WHEN o_orderkey % 61 = 0 THEN '  ' || o_orderpriority || ' ' ELSE o_orderpriority END AS o_orderpriority
  FROM orders WHERE o_orderkey % 97 <> 0
"""
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def from_sql(spark: SparkSession, folder: str, sql: str, *tables: str) -> DataFrame:
    """A derived input, written as SQL that both engines read alike."""
    from tideline.sources.sql import run_sql

    return run_sql(spark, sql.replace("VARCHAR", "STRING"), {t: table(spark, folder, t) for t in tables})
