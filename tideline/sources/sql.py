"""User SQL over named sources."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tideline.functions.names import trim_headers

DEFAULT_ALIAS = "source_table"


class EmptyInput(ValueError):
    """Nothing to work on: an empty query text, a table without rows or columns."""


def clean_sql(text: str) -> str:
    text = text.strip().rstrip(";").strip()
    if not text:
        raise EmptyInput("the SQL text is empty")
    return text


def read_sql_file(spark: SparkSession, path: str) -> str:
    """The query in a SQL file, wherever Spark can read it from."""
    return clean_sql(spark.read.text(path, wholetext=True).first()[0] or "")


def source_aliases(aliases: str | Sequence[str] | None, n: int) -> list[str]:
    """One alias per source; on a wrong number of aliases they are numbered."""
    given = [aliases] if isinstance(aliases, str) else list(aliases or [])
    if len(given) == n:
        return given
    return [DEFAULT_ALIAS] if n == 1 else [f"{DEFAULT_ALIAS}_{i + 1}" for i in range(n)]


def run_sql(spark: SparkSession, sql: str, sources: dict[str, DataFrame]) -> DataFrame:
    """Run the text with each source under its alias.

    Sources are bound as common table expressions over uniquely named views, so
    runs side by side in one session cannot see each other's aliases.
    """
    text = clean_sql(sql)
    bound, views = [], []
    try:
        for alias, df in sources.items():
            view = f"src_{uuid.uuid4().hex}"
            trim_headers(df).createOrReplaceTempView(view)
            views.append(view)
            bound.append("`" + alias.replace("`", "``") + f"` AS (SELECT * FROM {view})")
        return spark.sql(f"WITH {', '.join(bound)} (\n{text}\n)" if bound else text)
    finally:
        for view in views:
            spark.catalog.dropTempView(view)
