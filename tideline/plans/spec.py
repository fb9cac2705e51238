"""The spec of one table's job: a plain dict with defaults and checks."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from tideline.functions.convert import KINDS
from tideline.functions.names import SYSTEM_COLUMNS
from tideline.sinks.tables import check_batch_size

# Source and target kinds.  Workbooks are typed tables here.
SOURCE_TYPES = ("csv", "dbf", "fixed_text", "parquet", "orc", "json", "table", "custom_query")
TARGET_TYPES = ("parquet", "orc", "csv", "dbf", "fixed_text", "jdbc")
FILE_SOURCES = ("csv", "dbf", "fixed_text", "parquet", "orc", "json")
VERSIONED_TARGETS = ("parquet", "orc")
PARENT_TARGETS = ("parquet", "orc", "csv", "jdbc")


@dataclass
class QualityOptions:
    row_count: bool = True
    content: bool = True
    sample_percentage: float = 10.0
    exclude: tuple[str, ...] = SYSTEM_COLUMNS
    source_file: str | None = None


@dataclass
class TableSpec:
    """Settings of one table's load, checked when made."""

    target_table: str
    source_type: str = "csv"
    source_file_path: str | list[str] | None = None
    source_table: str | None = None
    source_schema: str | None = None
    target_type: str = "parquet"
    target_path: str | None = None
    batch_size: int = 1000
    custom_query: str | None = None
    data_source: dict[str, Any] = field(default_factory=dict)
    primary_key: list[str] = field(default_factory=list)
    foreign_keys: list[dict] = field(default_factory=list)
    indexes: list[dict] = field(default_factory=list)
    drop_if_exists: bool = True
    source_options: dict[str, Any] = field(default_factory=dict)
    target_options: dict[str, Any] = field(default_factory=dict)
    # Dates of file and table sources; a query's own text is left as it is.
    normalize_dates: bool = True
    date_columns: list[str] | None = None
    on_unparsed: str = "keep"
    min_share: float = 0.9
    # Column -> target kind: rows that do not convert go to a table of rejects.
    column_types: dict[str, str] = field(default_factory=dict)
    text_limit: int | None = None
    row_id: str | None = None
    # The target is replaced by a manifest written last, and only if the checks pass.
    versioned: bool = False
    quality: QualityOptions = field(default_factory=QualityOptions)

    def __post_init__(self) -> None:
        if not self.target_table:
            raise ValueError("target_table is required")
        if self.source_type not in SOURCE_TYPES:
            raise ValueError(f"source_type must be one of {SOURCE_TYPES}, got {self.source_type!r}")
        if self.target_type not in TARGET_TYPES:
            raise ValueError(f"target_type must be one of {TARGET_TYPES}, got {self.target_type!r}")
        if self.source_type in FILE_SOURCES and not self.source_file_path:
            raise ValueError(f"source_file_path is required for source type {self.source_type!r}")
        if self.source_type == "table" and not self.source_table:
            raise ValueError("source_table is required for source type 'table'")
        if self.source_type == "custom_query":
            if not self.custom_query:
                raise ValueError("custom_query (a SQL file) is required for source type 'custom_query'")
            kind = self.data_source.get("type")
            if kind == "table":
                if not self.data_source.get("table_name"):
                    raise ValueError("data_source.table_name is required")
            elif kind in FILE_SOURCES:
                if not self.data_source.get("file_path"):
                    raise ValueError("data_source.file_path is required")
            else:
                raise ValueError(f"data_source.type must be 'table' or one of {FILE_SOURCES}")
        if self.versioned and self.target_type not in VERSIONED_TARGETS:
            raise ValueError(f"versioned targets are one of {VERSIONED_TARGETS}, got {self.target_type!r}")
        if self.row_id not in (None, "random", "hash"):
            raise ValueError("row_id must be 'random', 'hash' or left out")
        if self.on_unparsed not in ("keep", "null"):
            raise ValueError("on_unparsed must be 'keep' or 'null'")
        if not 0 < self.min_share <= 1:
            raise ValueError("min_share must be above 0 and at most 1")
        wrong = sorted(set(self.column_types.values()) - set(KINDS))
        if wrong:
            raise ValueError(f"unknown target kinds {wrong}, expected some of {KINDS}")
        for fk in self.foreign_keys:
            columns, parents = fk.get("columns") or [], fk.get("references_columns") or fk.get("reference_columns") or []
            if columns and len(columns) != len(parents):
                raise ValueError(f"foreign key {columns}: as many references_columns are needed, got {parents}")
        check_batch_size(self.batch_size)

    @property
    def constraints(self) -> dict[str, Any]:
        return {"primary_key": self.primary_key, "foreign_keys": self.foreign_keys, "indexes": self.indexes}


def table_spec(settings: dict[str, Any]) -> TableSpec:
    """A spec from a settings dict as it stands in a job file."""
    s = dict(settings)
    s["source_type"] = str(s.get("source_type", "csv")).lower()
    s["target_type"] = str(s.get("target_type", "parquet")).lower()
    for kind in ("csv", "dbf", "xlsx"):
        if kind == s["source_type"] and f"{kind}_options" in s:
            s.setdefault("source_options", s[f"{kind}_options"])
        s.pop(f"{kind}_options", None)
    if "target_file_path" in s:
        s.setdefault("target_path", s.pop("target_file_path"))
    checks = s.pop("data_quality_checks", None) or {}
    s.setdefault(
        "quality",
        QualityOptions(
            checks.get("enable_row_count_check", True),
            checks.get("enable_content_check", True),
            float(checks.get("sample_percentage", 10.0)),
            tuple(checks.get("exclude_columns", SYSTEM_COLUMNS)),
            checks.get("source_file_identifier"),
        ),
    )
    unknown = sorted(set(s) - set(TableSpec.__dataclass_fields__))
    if unknown:
        raise ValueError(f"unknown settings: {unknown}")
    return TableSpec(**{k: v for k, v in s.items() if v is not None})
