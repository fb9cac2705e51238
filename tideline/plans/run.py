"""Run one table's job, or many with failures kept apart."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.names import col, resolve
from tideline.operators.constraints import check_constraints, constraint_columns
from tideline.operators.datetimes import found_patterns, rewrite_datetimes
from tideline.operators.profile import field_spec
from tideline.operators.reconcile import CHECK_SCHEMA, PASSED, row_count_check, run_checks
from tideline.operators.rejects import REASONS, SOURCE_ROW, convert_table, good_rows, rejected_rows
from tideline.operators.transform import CleaningOptions, clean_table
from tideline.plans.ledger import EXTRACTED, LOADED, Entry, Ledger, fingerprint
from tideline.plans.spec import PARENT_TARGETS, TableSpec, table_spec
from tideline.session import remove_path, scratch_dir
from tideline.sinks import versions
from tideline.sinks.fixed_width import fitted_fields, misfits, write_dbf, write_fixed_text
from tideline.sinks.history import append_history
from tideline.sinks.tables import with_row_id, write_database, write_table
from tideline.sources.database import read_query, read_table
from tideline.sources.delimited import read_delimited, split_options
from tideline.sources.fixed_width import Field, fields_from_spec, read_dbf, read_fixed_text
from tideline.sources.many import data_files, path_exists, read_delimited_files, read_typed_files, resolve_files
from tideline.sources.relaxed import read_relaxed_files
from tideline.sources.sql import EmptyInput, read_sql_file, run_sql, source_aliases
from tideline.sources.typed import read_typed_as_text
from tideline.sources.union import LINEAGE

REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("source_type", T.StringType()),
        T.StructField("extracted", T.BooleanType(), False),
        T.StructField("transformed", T.BooleanType(), False),
        T.StructField("loaded", T.BooleanType(), False),
        T.StructField("count_confirmed", T.BooleanType()),
        T.StructField("quality_passed", T.BooleanType()),
        T.StructField("violations", T.LongType()),
        T.StructField("total_rows", T.LongType(), False),
        T.StructField("rejected_rows", T.LongType()),
        # Date texts that no pattern of their column reads, and how many of these became NULL.
        T.StructField("dates_unread", T.LongType()),
        T.StructField("dates_nulled", T.LongType()),
        T.StructField("dates_changed", T.LongType()),
        T.StructField("unchecked_keys", T.ArrayType(T.StringType())),
        T.StructField("key_error", T.StringType()),
        T.StructField("violations_path", T.StringType()),
        T.StructField("rejects_path", T.StringType()),
        T.StructField("failed_stage", T.StringType()),
        T.StructField("error", T.StringType()),
        # The last stage that an earlier run had finished and this one did not repeat.
        T.StructField("resumed_after", T.StringType()),
    ]
)


class ChecksFailed(RuntimeError):
    """A versioned target was not replaced, because what was written did not pass."""


@dataclass
class TableRun:
    """What happened to one table."""

    table_name: str
    source_type: str | None = None
    extracted: bool = False
    transformed: bool = False
    loaded: bool = False
    count_confirmed: bool | None = False
    quality_passed: bool | None = False
    violations: int | None = None
    total_rows: int = 0
    rejected_rows: int | None = None
    dates_unread: int | None = None
    dates_nulled: int | None = None
    dates_changed: int | None = None
    key_error: str | None = None
    violations_path: str | None = None
    rejects_path: str | None = None
    failed_stage: str | None = None
    error: str | None = None
    resumed_after: str | None = None
    column_mapping: dict[str, str] = field(default_factory=dict)
    checks: list[Row] = field(default_factory=list)
    # Parents of foreign keys that were neither given nor found, so not checked.
    unchecked_keys: list[str] = field(default_factory=list)

    def report_row(self) -> tuple:
        return tuple(getattr(self, f.name) for f in REPORT_SCHEMA.fields)


def _read_files(spark: SparkSession, kind: str, files: Any, options: dict, data_dir: str | None) -> DataFrame:
    paths = resolve_files(spark, files, data_dir)
    many = not isinstance(files, str)
    if kind == "csv":
        if many:
            return read_delimited_files(spark, paths, options)
        if data_files(spark, paths[0]) != paths:
            # A folder or pattern is several files, whose headers may differ; the lineage is not asked for.
            return read_delimited_files(spark, paths, options).drop(LINEAGE)
        return read_delimited(spark, paths[0], **split_options(options))
    if kind == "fixed_text":
        options = dict(options)
        fields = [f if isinstance(f, Field) else Field(**f) for f in options.pop("fields")]
        return read_fixed_text(spark, paths, fields, lineage=many, **options)
    if kind == "dbf":
        return read_dbf(spark, paths, lineage=many, **options)
    if many and options.get("relaxed"):
        return read_relaxed_files(spark, paths, kind, options.get("on_loss", "refuse"))
    if many:
        return read_typed_files(spark, paths, kind, **{k: v for k, v in options.items() if k not in ("relaxed", "on_loss")})
    return read_typed_as_text(spark, paths[0], kind, **options)


def _read_query(spark: SparkSession, spec: TableSpec, data_dir: str | None) -> DataFrame:
    """SQL over named sources; over several database tables the database runs it."""
    source = spec.data_source
    options = dict(source.get("options", spec.source_options))
    sql = read_sql_file(spark, resolve_files(spark, spec.custom_query, data_dir)[0])
    if source["type"] == "table":
        tables = source["table_name"]
        if not isinstance(tables, str):
            return read_query(spark, options.pop("url"), sql, **options)
        frames = [read_table(spark, table=tables, schema=source.get("schema_name"), **options)]
    else:
        files = source["file_path"]
        names = [files] if isinstance(files, str) else list(files)
        frames = [_read_files(spark, source["type"], n, options, data_dir) for n in names]
    aliases = source_aliases(source.get("table_alias"), len(frames))
    return run_sql(spark, sql, dict(zip(aliases, frames)))


def read_source(spark: SparkSession, spec: TableSpec, data_dir: str | None = None) -> DataFrame:
    """The source of a spec as text, staged once in columnar form; refused if empty.

    Date detection, the write and the checks all read the staged copy, so a file is
    parsed once and a database or query runs once.  User SQL sees the source's own text.
    """
    if spec.source_type == "custom_query":
        return staged(_read_query(spark, spec, data_dir))
    if spec.source_type == "table":
        return staged(read_table(spark, table=spec.source_table, schema=spec.source_schema, **spec.source_options))
    return staged(_read_files(spark, spec.source_type, spec.source_file_path, spec.source_options, data_dir))


def staged(df: DataFrame, refuse_empty: bool = True) -> DataFrame:
    """The table written to the scratch folder and read back.

    An extracted table must hold rows; that declared steps leave none is a result.
    """
    if not df.columns:
        raise EmptyInput("the extracted table has no columns")
    path = scratch_dir(df.sparkSession, "staged")
    if write_table(df, path) == 0 and refuse_empty:
        remove_path(df.sparkSession, path)
        raise EmptyInput("the extracted table is empty")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _folder(df: DataFrame) -> str:
    """Where a staged table's files are."""
    return df.inputFiles()[0].rsplit("/", 1)[0]


def _forget(df: DataFrame) -> None:
    """Delete the staged files of a table."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_path(df.sparkSession, path)


def _with_dates(df: DataFrame, spec: TableSpec, run: TableRun) -> DataFrame:
    """Dates in their common text form; what was not read, and what changed, is counted."""
    wanted = spec.date_columns
    names = None if wanted is None else resolve(wanted, df.columns, "date columns")
    found = found_patterns(df, names, min_share=spec.min_share)
    run.dates_unread = sum(unread for _, unread in found.values())
    run.dates_nulled = run.dates_unread if spec.on_unparsed == "null" else 0
    run.dates_changed = 0
    out = rewrite_datetimes(df, {n: p for n, (p, _) in found.items()}, spec.on_unparsed)
    if found:
        pairs = rewrite_datetimes(
            df.select(*[col(n) for n in found], *[col(n).alias(f"__raw_{k}") for k, n in enumerate(found)]),
            {n: p for n, (p, _) in found.items()},
            spec.on_unparsed,
        )
        changed = [F.count_if(col(n).isNotNull() & (col(n) != col(f"__raw_{k}"))).alias(f"c{k}") for k, n in enumerate(found)]
        run.dates_changed = sum(pairs.agg(*changed).first())
    return out


def _target_path(spec: TableSpec, target_dir: str | None) -> str:
    if spec.target_path:
        return spec.target_path
    if not target_dir:
        raise ValueError(f"{spec.target_table}: neither target_path nor a target folder is given")
    return f"{target_dir.rstrip('/')}/{spec.target_table}"


def _write(df: DataFrame, spec: TableSpec, path: str, fields: list[Field] | None = None) -> int:
    """Write to the target; the number of rows, counted by the same pass."""
    mode = "replace" if spec.drop_if_exists else "fail"
    options = {k: v for k, v in spec.target_options.items() if k not in ("fields", "on_overflow")}
    overflow = "cut" if spec.target_options.get("on_overflow") == "cut" else "refuse"
    if spec.target_type in ("parquet", "orc", "csv"):
        # Delimited targets are read back with doubled quotes and all white space.
        plain = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        options = {**plain, **spec.target_options} if spec.target_type == "csv" else spec.target_options
        return write_table(df, path, mode, spec.target_type, **options)
    seen = Observation()
    df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if spec.target_type == "jdbc":
        write_database(df, table=spec.target_table, mode=mode, batch_size=spec.batch_size, **spec.target_options)
    elif spec.target_type == "dbf":
        write_dbf(df, path, fields, mode, on_overflow=overflow, **options)
    else:
        write_fixed_text(df, path, fields, mode, overflow, **options)
    return seen.get["rows"]


def _read_back(spark: SparkSession, spec: TableSpec, path: str, columns: Sequence[str] = (), fields: list[Field] | None = None) -> DataFrame:
    """The written table under the names of the columns that were written."""
    if spec.target_type == "jdbc":
        return read_table(spark, table=spec.target_table, **spec.target_options)
    if spec.target_type == "csv":
        options = {"multiLine": True, **spec.target_options}
        return read_delimited(spark, path, **{**split_options(options), "null_tokens": ()})
    if spec.target_type == "fixed_text":
        return read_fixed_text(spark, path, fields)
    if spec.target_type == "dbf":
        return read_dbf(spark, path, _encoding(spec)).toDF(*columns)
    return spark.read.format(spec.target_type).load(path)


def run_table(
    spark: SparkSession,
    spec: TableSpec | dict,
    data_dir: str | None = None,
    target_dir: str | None = None,
    source: DataFrame | None = None,
    cleaning: CleaningOptions | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    history_path: str | None = None,
) -> TableRun:
    """Extract, validate, clean, convert, write, check keys, reconcile.  Errors are raised."""
    spec = spec if isinstance(spec, TableSpec) else table_spec(spec)
    run = TableRun(spec.target_table, spec.source_type)
    _run(spark, run, spec, data_dir, target_dir, source, cleaning, parents, history_path)
    return run


def _run(
    spark: SparkSession,
    run: TableRun,
    spec: TableSpec,
    data_dir: str | None,
    target_dir: str | None,
    source: DataFrame | None,
    cleaning: CleaningOptions | None,
    parents: Mapping[str, DataFrame] | None,
    history_path: str | None,
    siblings: Mapping[str, TableSpec | None] | None = None,
    ledger: Ledger | None = None,
) -> None:
    """Fill in ``run``; where an error is raised it tells how far the run came."""
    held: list[DataFrame] = []
    version: versions.Version | None = None
    entry: Entry | None = None
    try:
        run.failed_stage = "extract"
        mark = fingerprint(spark, spec, data_dir, cleaning) if ledger is not None and source is None else None
        entry = ledger.resumable(spec.target_table, mark) if ledger is not None else None
        if entry is not None:
            raw, run.resumed_after = ledger.rows(entry), entry.done
        else:
            raw = read_source(spark, spec, data_dir) if source is None else staged(source)
            if mark is not None:
                entry = Entry(mark, _folder(raw), EXTRACTED)
                ledger.write(spec.target_table, entry)
            else:
                held.append(raw)
        constraint_columns(raw, spec.constraints)
        run.extracted = True

        run.failed_stage = "transform"
        query = spec.source_type == "custom_query"
        dated = _with_dates(raw, spec, run) if spec.normalize_dates and source is None and not query else raw
        cleaned, run.column_mapping = clean_table(dated, cleaning)
        if cleaning is not None and cleaning.remove_duplicates and cleaning.dedupe_subset and not cleaning.dedupe_order:
            # Any row of a key may stay, so it has to be chosen once.
            cleaned = staged(cleaned, refuse_empty=False)
            held.append(cleaned)
        rejects = None
        path = "" if spec.target_type == "jdbc" else _target_path(spec, target_dir)
        fields = None
        if spec.column_types:
            kinds = {_final_name(n, run.column_mapping): k for n, k in spec.column_types.items()}
            resolve(list(kinds), cleaned.columns, "typed columns")
            split = staged(convert_table(cleaned, kinds, spec.text_limit), refuse_empty=False)
            held.append(split)
            cleaned, rejects = good_rows(split), rejected_rows(split)
        if spec.target_type in ("dbf", "fixed_text"):
            fields = _target_fields(cleaned, spec)
        if fields and not spec.column_types and spec.target_options.get("on_overflow", "reject") == "reject":
            split = staged(
                cleaned.withColumn(REASONS, misfits(cleaned, fields, _encoding(spec)))
                .withColumn(SOURCE_ROW, F.to_json(F.struct(*[col(c) for c in cleaned.columns]), {"ignoreNullFields": "false"})),
                refuse_empty=False,
            )
            held.append(split)
            cleaned, rejects = good_rows(split), rejected_rows(split)
        run.transformed = True

        run.failed_stage = "load"
        expected = cleaned
        if spec.row_id:
            cleaned = with_row_id(cleaned, deterministic=spec.row_id == "hash")
        written = entry is not None and entry.done == LOADED and entry.target == path and path_exists(spark, path)
        if written:
            run.total_rows = entry.rows
        elif spec.versioned:
            newest = versions.newest(spark, path)
            version = versions.stage_version(cleaned, path, spec.target_type, **spec.target_options)
            run.total_rows = version.rows
        else:
            run.total_rows = _write(cleaned, spec, path, fields)
        if rejects is not None:
            run.rejects_path = f"{path}__rejects" if path else scratch_dir(spark, "rejects")
            run.rejected_rows = write_table(rejects, run.rejects_path)
        run.loaded = not spec.versioned
        if entry is not None and path and not spec.versioned and spec.row_id != "random":
            entry.done, entry.rows, entry.target = LOADED, run.total_rows, path
            ledger.write(spec.target_table, entry)

        run.failed_stage = "check"
        target = versions.read_version(spark, path, version=version) if spec.versioned else _read_back(spark, spec, path, cleaned.columns, fields)
        run.count_confirmed = target.count() == run.total_rows
        try:
            _check_keys(spark, run, spec, target, target_dir, path, parents, siblings)
        except Exception as e:
            # Keys warn; they never fail a load.
            run.key_error = str(e)
            warnings.warn(f"{spec.target_table}: keys were not checked: {e}", stacklevel=2)

        q = spec.quality
        if q.row_count or q.content:
            if run.total_rows == 0 and expected.isEmpty():
                # The steps left nothing: there is no content to compare.
                checks = row_count_check(expected, target, spec.target_table)
            else:
                checks = run_checks(
                    expected, target, spec.target_table, q.sample_percentage,
                    exclude=q.exclude, source_file=q.source_file, row_count=q.row_count, content=q.content,
                )
            run.checks = checks.collect()
            run.quality_passed = all(r["status"] == PASSED for r in run.checks)
            if history_path:
                append_history(checks, history_path)
        else:
            run.quality_passed = True
        if spec.versioned:
            if not (run.quality_passed and run.count_confirmed):
                raise ChecksFailed(f"{spec.target_table}: the checks failed, so the table stays as it was")
            versions.commit(spark, path, version, newest)
            version, run.loaded = None, True
        run.failed_stage = None
        if entry is not None:
            ledger.close(spec.target_table)
    finally:
        if version is not None:
            versions.discard(spark, path, version)
        for df in held:
            _forget(df)


def _encoding(spec: TableSpec) -> str | None:
    return spec.target_options.get("encoding", "windows-1252") if spec.target_type == "dbf" else None


def _target_fields(df: DataFrame, spec: TableSpec) -> list[Field]:
    """Declared fields, or the data's, with numbers as wide as they are."""
    declared = spec.target_options.get("fields")
    if declared:
        return [f if isinstance(f, Field) else Field(**f) for f in declared]
    return fitted_fields(df, fields_from_spec(field_spec(df)))


def _check_keys(
    spark: SparkSession,
    run: TableRun,
    spec: TableSpec,
    target: DataFrame,
    target_dir: str | None,
    path: str,
    parents: Mapping[str, DataFrame] | None,
    siblings: Mapping[str, TableSpec | None] | None,
) -> None:
    """Count violations of the declared keys, and keep them as a table if there are any."""

    def final(columns: Sequence[str] | None) -> list[str]:
        return [_final_name(c, run.column_mapping) for c in columns or []]

    keys = {
        "primary_key": final(spec.primary_key),
        "indexes": [{**i, "columns": final(i.get("columns"))} for i in spec.indexes],
        "foreign_keys": [{**k, "columns": final(k.get("columns"))} for k in spec.foreign_keys],
    }
    known = _parents(spark, spec, target_dir, parents, siblings)
    run.unchecked_keys = [t for fk in spec.foreign_keys if (t := _parent_name(fk)) and t.upper() not in known]
    found = check_constraints(target, keys, known)
    if found is None:
        run.violations = 0
        return
    kept = f"{path}__violations" if path else scratch_dir(spark, "violations")
    run.violations = write_table(found, kept)
    if run.violations:
        run.violations_path = kept
    else:
        remove_path(spark, kept)


def _parent_name(foreign_key: Mapping[str, Any]) -> str | None:
    return foreign_key.get("references_table") or foreign_key.get("reference_table")


def _parents(
    spark: SparkSession,
    spec: TableSpec,
    target_dir: str | None,
    given: Mapping[str, DataFrame] | None,
    siblings: Mapping[str, TableSpec | None] | None = None,
) -> dict[str, DataFrame]:
    """Parent tables by upper-case name: those given, those this run wrote, those in the target folder.

    A table of this run that did not load (None) is no parent, whatever an earlier run left in its place.
    """
    known = {name.upper(): df for name, df in (given or {}).items()}
    for name in filter(None, map(_parent_name, spec.foreign_keys)):
        if name.upper() in known:
            continue
        if name.upper() in (siblings or {}):
            sibling = siblings[name.upper()]
            if sibling is None or sibling.target_type not in PARENT_TARGETS:
                continue
            path = "" if sibling.target_type == "jdbc" else _target_path(sibling, target_dir)
            if sibling.versioned:
                known[name.upper()] = versions.read_version(spark, path)
            elif sibling.target_type == "jdbc" or path_exists(spark, path):
                known[name.upper()] = _read_back(spark, sibling, path)
        elif target_dir and path_exists(spark, path := f"{target_dir.rstrip('/')}/{name}"):
            found = versions.is_versioned(spark, path)
            known[name.upper()] = versions.read_version(spark, path) if found else spark.read.format(_format_of(spark, path)).load(path)
    return known


def _format_of(spark: SparkSession, path: str) -> str:
    """The format of a written table, by the names of its files."""
    return "orc" if any(f.endswith(".orc") for f in data_files(spark, path)) else "parquet"


def _final_name(name: str, mapping: Mapping[str, str]) -> str:
    """A spec's column name as the target spells it, ignoring case."""
    key = name.strip().lower()
    return next((final for raw, final in mapping.items() if raw.strip().lower() == key), name)


def run_tables(
    spark: SparkSession,
    tables: Mapping[str, dict],
    data_dir: str | None = None,
    target_dir: str | None = None,
    cleaning: CleaningOptions | None = None,
    parents: Mapping[str, DataFrame] | None = None,
    history_path: str | None = None,
    parallel: int = 1,
    ledger_dir: str | None = None,
) -> list[TableRun]:
    """Run every table, parents before children; one that fails is reported and the others go on.

    With ``parallel`` above one that many tables' jobs share the cluster.  With a ``ledger_dir`` a table
    that failed keeps its extracted rows, and the next run with the same spec and source files goes on from
    the last finished stage; where random row ids are asked for, the target is written again.
    """
    ledger = Ledger(spark, ledger_dir) if ledger_dir else None

    runs: dict[str, TableRun] = {}
    specs: dict[str, TableSpec] = {}
    for name, settings in tables.items():
        runs[name] = TableRun(settings.get("target_table") or name, settings.get("source_type"))
        try:
            specs[name] = table_spec(settings)
        except Exception as e:
            runs[name].failed_stage, runs[name].error = "spec", str(e)
    by_target = {s.target_table.upper(): name for name, s in specs.items()}
    siblings = {s.target_table.upper(): s for s in specs.values()}

    def one(name: str) -> None:
        # Parents that failed to load are not there to be checked against.
        known = {t: s if runs[by_target[t]].loaded else None for t, s in siblings.items()}
        try:
            _run(spark, runs[name], specs[name], data_dir, target_dir, None, cleaning, parents, history_path, known, ledger)
        except Exception as e:
            runs[name].error = str(e)

    waiting = dict.fromkeys(specs)
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        while waiting:
            needs = {n: {by_target.get((_parent_name(k) or "").upper()) for k in specs[n].foreign_keys} - {n, None} for n in waiting}
            # Tables whose keys point at each other in a circle go last, together.
            ready = [n for n in waiting if not needs[n] & set(waiting)] or list(waiting)
            list(pool.map(one, ready))
            for n in ready:
                del waiting[n]
    return [runs[name] for name in tables]


def run_report(spark: SparkSession, runs: list[TableRun]) -> DataFrame:
    """One row per table."""
    return spark.createDataFrame([r.report_row() for r in runs], REPORT_SCHEMA)


def run_summary(report: DataFrame) -> DataFrame:
    """Totals of a run report."""
    return report.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if("loaded").alias("succeeded"),
        F.count_if(~F.col("loaded")).alias("failed"),
        F.count_if("quality_passed").alias("quality_passed"),
        F.coalesce(F.sum("total_rows"), F.lit(0)).cast("bigint").alias("total_rows"),
    )


__all__ = [
    "CHECK_SCHEMA", "REPORT_SCHEMA", "TableRun", "read_source", "run_report", "run_summary",
    "run_table", "run_tables",
]
