"""Database tables and queries over JDBC, read in parallel ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_options(
    url: str,
    table: str,
    schema: str | None = None,
    split_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> dict[str, str]:
    """Reader options for a whole table.

    With a split column the table is read in ``partitions`` ranges; without one
    a single task reads it all, which only small tables should.
    """
    out = {"url": url, "dbtable": f"{schema}.{table}" if schema else table, "fetchsize": str(fetch_size), **options}
    ranged = (split_column, lower, upper, partitions)
    if any(v is not None for v in ranged):
        if any(v is None for v in ranged):
            raise ValueError("split_column, lower, upper and partitions go together")
        out |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return out


def query_options(url: str, sql: str, fetch_size: int = 10_000, **options: str) -> dict[str, str]:
    """Reader options for a query the database runs whole."""
    text = sql.strip().rstrip(";")
    if not text:
        raise ValueError("the query text is empty")
    return {"url": url, "query": text, "fetchsize": str(fetch_size), **options}


def read_table(spark: SparkSession, url: str, table: str, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**table_options(url, table, **kwargs)).load()


def read_query(spark: SparkSession, url: str, sql: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**query_options(url, sql, **options)).load()
