"""Column names: cleaning, resolving, aligning.  Nothing here touches rows."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that may not stand alone as a target column name.
RESERVED_WORDS = {
    "ACCESS", "ADD", "ALL", "ALTER", "AND", "ANY", "AS", "ASC", "AUDIT", "BETWEEN", "BY", "CHAR", "CHECK", "CLUSTER",
    "COLUMN", "COMMENT", "COMPRESS", "CONNECT", "CREATE", "CURRENT", "DATE", "DECIMAL", "DEFAULT", "DELETE", "DESC",
    "DISTINCT", "DROP", "ELSE", "EXCLUSIVE", "EXISTS", "FILE", "FLOAT", "FOR", "FROM", "GRANT", "GROUP", "HAVING",
    "IDENTIFIED", "IMMEDIATE", "IN", "INCREMENT", "INDEX", "INITIAL", "INSERT", "INTEGER", "INTERSECT", "INTERVAL",
    "INTO", "IS", "LEVEL", "LIKE", "LOCK", "LONG", "MAXEXTENTS", "MINUS", "MODE", "MODIFY", "NOAUDIT", "NOCOMPRESS",
    "NOT", "NOWAIT", "NULL", "NUMBER", "OF", "OFFLINE", "ON", "ONLINE", "OPTION", "OR", "ORDER", "PARTITION",
    "PCTFREE", "PRIOR", "PUBLIC", "RAW", "RENAME", "RESOURCE", "REVOKE", "ROW", "ROWID", "ROWNUM", "ROWS", "SELECT",
    "SESSION", "SET", "SHARE", "SIZE", "SMALLINT", "START", "SUBPARTITION", "SUCCESSFUL", "SYNONYM", "SYSDATE",
    "TABLE", "THEN", "TIMESTAMP", "TO", "TRIGGER", "UID", "UNION", "UNIQUE", "UPDATE", "USER", "VALIDATE", "VALUES",
    "VARCHAR", "VARCHAR2", "VIEW", "WHENEVER", "WHERE", "WITH",
}
MAX_NAME_LENGTH = 30
# Columns the load itself adds, left out of comparisons.
SYSTEM_COLUMNS = ("U_ID", "SOURCE_FILE")


class MissingColumns(ValueError):
    """Columns a spec names that the data does not have."""


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def _stem(raw: str) -> str:
    name = re.sub(r"\W", "_", raw.strip()).strip("_")
    name = re.sub(r"_+", "_", name)
    if not name:
        return "UNNAMED_COLUMN"
    if name[0].isdigit():
        name = "COL_" + name
    return name + "_COL" if name.upper() in RESERVED_WORDS else name


def _numbered(stem: str, clash: int) -> str:
    """The stem's ``clash``-th spelling, never longer than the limit."""
    name = f"{stem}_{clash}" if clash else stem
    if len(name) <= MAX_NAME_LENGTH:
        return name
    suffix = f"_{clash + 1:02d}"
    return stem[: MAX_NAME_LENGTH - len(suffix)] + suffix


def clean_names(names: Sequence[str]) -> list[str]:
    """Target-safe spellings, position by position, unique ignoring case."""
    taken: set[str] = set()
    result = []
    for raw in names:
        stem, clash = _stem(raw), 0
        while (name := _numbered(stem, clash)).upper() in taken:
            clash += 1
        taken.add(name.upper())
        result.append(name)
    return result


def trim_headers(df: DataFrame) -> DataFrame:
    """Column names without surrounding whitespace."""
    return df.toDF(*[name.strip() for name in df.columns])


def clean_headers(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Rename every column to its target-safe name; also give raw -> final."""
    final = clean_names(df.columns)
    return df.toDF(*final), dict(zip(df.columns, final))


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Apply a rename mapping; names it does not mention stay."""
    return df.toDF(*[mapping.get(name, name) for name in df.columns])


def resolve(wanted: Iterable[str], available: Sequence[str], role: str = "columns") -> list[str]:
    """Find columns ignoring case and outer spaces; fail naming the missing ones."""
    by_key = {name.strip().lower(): name for name in reversed(available)}
    wanted = list(wanted)
    missing = [name for name in wanted if name.strip().lower() not in by_key]
    if missing:
        raise MissingColumns(f"{role} not found in data: {missing}")
    return [by_key[name.strip().lower()] for name in wanted]


def align(
    source: Sequence[str], target: Sequence[str], exclude: Iterable[str] = SYSTEM_COLUMNS
) -> list[tuple[str, str]]:
    """Pairs (source name, target name) of the columns both sides have."""
    by_key = {name.upper(): name for name in reversed(target)}
    left_out = {name.upper() for name in exclude}
    return [
        (name, by_key[name.upper()])
        for name in source
        if name.upper() in by_key and name.upper() not in left_out
    ]
