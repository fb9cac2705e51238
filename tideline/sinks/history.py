"""The history of check results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_COLUMNS = (
    "ID", "TABLE_NAME", "CHECK_TYPE", "CHECK_TIME", "SOURCE_COUNT", "TARGET_COUNT", "SAMPLE_SIZE",
    "MATCHING_ROWS", "ACCURACY_PERCENTAGE", "STATUS", "ERROR_MESSAGE", "CREATED_AT",
)


def history_rows(checks: DataFrame) -> DataFrame:
    """Check rows in the history table's form, stamped now."""
    now = F.current_timestamp()
    out = []
    for name in HISTORY_COLUMNS:
        if name == "ID":
            c = F.uuid()
        elif name in ("CHECK_TIME", "CREATED_AT"):
            c = now
        elif name == "ACCURACY_PERCENTAGE":
            c = F.col("accuracy_percentage").cast("decimal(38,2)")
        elif name == "ERROR_MESSAGE":
            c = F.substring("error_message", 1, 4000)
        else:
            c = F.col(name.lower())
        out.append(c.alias(name))
    return checks.select(*out)


def append_history(checks: DataFrame, path: str) -> None:
    history_rows(checks).write.mode("append").parquet(path)


def read_history(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """Checks of one table or all, newest first."""
    df = spark.read.parquet(path)
    if table is not None:
        df = df.filter(F.col("TABLE_NAME") == F.lit(table))
    return df.orderBy(F.col("CHECK_TIME").desc(), F.col("TABLE_NAME"), F.col("CHECK_TYPE"))
