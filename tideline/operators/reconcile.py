"""Does the target hold what the source held?  Counts, content sample, discrepancies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.names import SYSTEM_COLUMNS, align, col, rename
from tideline.functions.text import compare_text
from tideline.operators.sample import ORDER, PREFIX_DIGITS, Cutoff, find_cutoff, hash_order
from tideline.operators.sketches import column_sketches, sketch_counts
from tideline.session import remove_path, scratch_dir

# Check and status words, report limits.
ROW_COUNT, CONTENT, SYSTEM_ERROR = "ROW_COUNT", "CONTENT_ACCURACY", "SYSTEM_ERROR"
PASSED, FAILED = "PASSED", "FAILED"
REPORT_ROWS, REPORT_COLUMNS, REPORT_EXAMPLES, REPORT_TEXT = 5, 3, 3, 3900
REPORT_ANALYSED, REPORT_VALUE = 5, 50
# How far the match pass reaches beyond the sample, and in how many hash digits.
REACH_MARGIN, REACH_DIGITS, SMALLEST_REACH = 1.1, 8, 0.001
# Hashes (about 100 bytes each) that may be sent to every task.
BROADCAST_HASHES = 200_000

CHECK_SCHEMA = T.StructType(
    [
        T.StructField("check_type", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("source_count", T.LongType()),
        T.StructField("target_count", T.LongType()),
        T.StructField("sample_size", T.LongType()),
        T.StructField("matching_rows", T.LongType()),
        T.StructField("accuracy_percentage", T.DoubleType()),
        T.StructField("status", T.StringType(), False),
        T.StructField("error_message", T.StringType()),
    ]
)


def only_source_file(df: DataFrame, source_file: str | None) -> DataFrame:
    """Rows that came from one file, named by its whole path or by its base name."""
    lineage = [name for name in df.columns if name.strip("_").upper() == "SOURCE_FILE"]
    if source_file is None or not lineage:
        return df
    path = col(lineage[0])
    named = path == F.lit(source_file)
    return df.filter(named if "/" in source_file else named | F.endswith(path, F.lit("/" + source_file)))


def percentage(part: Column, whole: Column) -> Column:
    """100 * part / whole to two digits; 0 when there is nothing to divide by."""
    share = F.round(F.lit(100.0) * part.cast("double") / F.when(whole != 0, whole).cast("double"), 2)
    return F.coalesce(share, F.lit(0.0))


def _check_row(frame: DataFrame, **columns: Column) -> DataFrame:
    """Exactly the check schema; columns not given are NULL."""
    return frame.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CHECK_SCHEMA.fields]
    )


def failed_check(spark, check_type: str, table: str, message: str, **known) -> DataFrame:
    values = {"check_type": check_type, "table_name": table, "status": FAILED, "error_message": message, **known}
    return spark.createDataFrame([tuple(values.get(f.name) for f in CHECK_SCHEMA.fields)], CHECK_SCHEMA)


def row_count_check(
    source: DataFrame, target: DataFrame, table: str, source_file: str | None = None
) -> DataFrame:
    """One check row: do both sides have the same number of rows?

    Both sides are counted in one job.  With ``source_file`` each side that has
    the lineage column is restricted to that file.
    """
    left = only_source_file(source, source_file).select(F.lit(1).alias("s"), F.lit(0).alias("t"))
    right = only_source_file(target, source_file).select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    zero = F.lit(0).cast("bigint")
    counts = left.unionAll(right).agg(
        F.coalesce(F.sum("s"), zero).alias("s"), F.coalesce(F.sum("t"), zero).alias("t")
    )
    return _row_count_row(counts, table, source_file)


def _row_count_row(counts: DataFrame, table: str, source_file: str | None = None) -> DataFrame:
    """The row-count check of one row of counts ``s`` (source) and ``t`` (target).

    A file that no source row came from confirms nothing, so it fails.
    """
    s, t = F.col("s"), F.col("t")
    nothing = F.lit(source_file is not None) & (s == 0)
    gap = F.abs(s - t)
    message = F.concat(
        F.when(s > t, F.lit("Missing ")).otherwise(F.lit("Surplus ")),
        gap.cast("string"),
        F.lit(" rows ("),
        F.format_string("%.2f", percentage(gap, s)),
        F.lit("%)"),
    )
    return _check_row(
        counts,
        check_type=F.lit(ROW_COUNT),
        table_name=F.lit(table),
        source_count=s,
        target_count=t,
        accuracy_percentage=F.when(nothing, F.lit(0.0)).when(s == t, F.lit(100.0)).otherwise(percentage(t, s)),
        status=F.when((s == t) & ~nothing, F.lit(PASSED)).otherwise(F.lit(FAILED)),
        error_message=F.when(nothing, F.lit(f"no source row came from file {source_file}")).when(s != t, message),
    )


class NothingToCompare(ValueError):
    """Content cannot be compared; carries the counts known so far."""

    def __init__(self, message: str, source_count: int | None = None, target_count: int | None = None):
        super().__init__(message)
        self.source_count, self.target_count = source_count, target_count


@dataclass(frozen=True)
class Comparison:
    """Both sides as comparison text, and what the match of the sample found.

    ``matches`` is a small written table: per distinct row in reach of the sample
    its hash and how often each side has it.  Counts, the sample's exact end and
    the check itself are all read from it.
    """

    source: DataFrame
    target: DataFrame
    matches: DataFrame
    columns: list[str]
    source_count: int
    target_count: int
    sample_size: int
    cutoff: Cutoff
    path: str = ""

    def forget(self) -> None:
        """Delete the match table, once everything is read from it."""
        remove_path(self.source.sparkSession, self.path)

    def sampled(self) -> DataFrame:
        """Distinct sampled rows: hash, copies in the sample, copies in the target."""
        order = F.col(ORDER)
        copies = F.col("s")
        if self.cutoff.ties is not None:
            copies = F.when(self.cutoff.is_tie(order), F.lit(self.cutoff.ties)).otherwise(copies)
        inside = (F.col("s") > 0) & order.isNotNull() & self.cutoff.contains(order)
        return self.matches.filter(inside).select(order, copies.cast("bigint").alias("copies"), F.col("t").alias("found"))


def _comparable(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = [compare_text(col(name), types[name]).alias(alias) for name, alias in pairs]
    return df.select(*texts).withColumn(ORDER, hash_order([col(alias) for _, alias in pairs]))


def _reach(share: float) -> str:
    """The hash prefix below which this share of evenly spread hashes lies."""
    return f"{min(int(share * 16**REACH_DIGITS), 16**REACH_DIGITS - 1):0{REACH_DIGITS}x}"


def _write_matches(left: DataFrame, right: DataFrame, share: float) -> tuple[DataFrame, str]:
    """Count both sides per row hash, in one pass over each.

    Equal rows have equal hashes, so rows beyond the sample's reach need not be
    told apart: they fall into one group, which keeps the totals.  Copies of a row
    are counted before the shuffle, and only hashes and counters are shuffled.
    """
    order = F.col(ORDER)
    key = order if share >= 1 else F.when(F.substring(order, 1, REACH_DIGITS) <= _reach(share), order)
    both = left.select(key.alias(ORDER), F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        right.select(key.alias(ORDER), F.lit(0), F.lit(1))
    )
    path = scratch_dir(left.sparkSession, "matches")
    both.groupBy(ORDER).agg(F.sum("s").alias("s"), F.sum("t").alias("t")).write.parquet(path)
    return left.sparkSession.read.parquet(path), path


def prepare_comparison(
    source: DataFrame,
    target: DataFrame,
    sample_percentage: float = 10.0,
    mapping: dict[str, str] | None = None,
    exclude: Sequence[str] = SYSTEM_COLUMNS,
    source_file: str | None = None,
) -> Comparison:
    """Align, normalise, match and sample, reading each side once.

    The sample is the given percentage of the smaller side.  Its size is known
    only after the pass that also matches it, so that pass reaches a little
    further than the percentage; should a hot row leave it short, it is repeated
    with a wider reach.
    """
    if mapping:
        source = rename(source, mapping)
    source, target = only_source_file(source, source_file), only_source_file(target, source_file)
    pairs = align(source.columns, target.columns, exclude)
    if not pairs:
        raise NothingToCompare(
            f"the two sides share no column to compare (left out: {', '.join(exclude) or 'none'})"
        )
    left = _comparable(source, [(s, s) for s, _ in pairs])
    right = _comparable(target, [(t, s) for s, t in pairs])
    share = min(1.0, max(SMALLEST_REACH, sample_percentage / 100 * REACH_MARGIN))
    while True:
        matches, path = _write_matches(left, right, share)
        part = F.substring(ORDER, 1, PREFIX_DIGITS).alias("part")
        rows = matches.groupBy(part).agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()
        source_count, target_count = sum(r["s"] for r in rows), sum(r["t"] for r in rows)
        if source_count == 0:
            raise NothingToCompare("the source side has no rows" + (f" from file {source_file}" if source_file else ""), source_count, target_count)
        if target_count == 0:
            suffix = f" from file {source_file}" if source_file else ""
            raise NothingToCompare("the target side has no rows" + suffix, source_count, target_count)
        wanted = max(1, int(sample_percentage / 100 * min(source_count, target_count)))
        wanted = min(wanted, source_count)
        first = sorted((r["part"], r["s"]) for r in rows if r["part"] is not None)
        if share >= 1 or sum(n for _, n in first) >= wanted:
            break
        share = min(1.0, share * 4)
    cutoff = Cutoff()
    if wanted < source_count:
        cutoff = find_cutoff(matches.filter(F.col(ORDER).isNotNull()), wanted, first, weight=F.col("s"))
    return Comparison(left, right, matches, [s for s, _ in pairs], source_count, target_count, wanted, cutoff, path)


def content_check(c: Comparison, table: str, count_copies: bool = False) -> DataFrame:
    """One check row: how much of the sample is in the target?

    A row counts as found if the target has it at all; with ``count_copies`` it
    must have it as often as the sample does.
    """
    copies, found = F.col("copies"), F.col("found")
    hit = F.least(copies, found) if count_copies else F.when(found > 0, copies).otherwise(0)
    totals = c.sampled().agg(F.sum(hit).alias("m"), F.sum(copies).alias("n"))
    m, n = F.col("m"), F.col("n")
    message = F.concat(
        (n - m).cast("string"),
        F.lit(" of "),
        n.cast("string"),
        F.lit(f" sampled rows are not in the target; the source has {c.source_count} rows, the target {c.target_count}."),
    )
    return _check_row(
        totals,
        check_type=F.lit(CONTENT),
        table_name=F.lit(table),
        source_count=F.lit(c.source_count),
        target_count=F.lit(c.target_count),
        sample_size=n,
        matching_rows=m,
        accuracy_percentage=percentage(m, n),
        status=F.when(m == n, F.lit(PASSED)).otherwise(F.lit(FAILED)),
        error_message=F.when(m != n, message),
    )


def _sampled_rows(c: Comparison, wanted: DataFrame) -> DataFrame:
    """The distinct source rows behind some sampled hashes, with their copies.

    A few hashes (counted in the small match table) are sent to every task, so
    only their rows are shuffled.  Many are joined by a shuffle, with copies of a
    row dropped in each task before it.
    """
    hashes = wanted.select(ORDER, "copies")
    names = [*[col(n) for n in c.columns], "copies"]
    if hashes.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES:
        return c.source.join(F.broadcast(hashes), ORDER).select(ORDER, *names).distinct().select(*names)
    inside = c.source.filter(c.cutoff.contains(F.col(ORDER)))
    return inside.distinct().join(hashes, ORDER).select(*names)


def matched_rows(c: Comparison) -> DataFrame:
    """Distinct sampled rows the target has, with their number of copies."""
    return _sampled_rows(c, c.sampled().filter(F.col("found") > 0))


def mismatched_rows(c: Comparison) -> DataFrame:
    """Distinct sampled rows the target lacks, with their number of copies."""
    return _sampled_rows(c, c.sampled().filter(F.col("found") == 0))


def first_mismatches(c: Comparison, rows: int = REPORT_ROWS) -> list[Row]:
    """The report's few mismatched rows, in sample order.

    Their hashes come from the small match table, so the source is read with a
    filter on a handful of hashes.
    """
    missing = c.sampled().filter(F.col("found") == 0).orderBy(ORDER).limit(rows).collect()
    if not missing:
        return []
    found = c.source.filter(F.col(ORDER).isin(*[r[ORDER] for r in missing])).distinct().collect()
    return sorted(found, key=lambda r: r[ORDER])


def nearest_rows(missing: Sequence[Row], target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each of a few rows, the target row with most equal columns.

    The rows are literals of one aggregate over the target, whose partial results
    are one candidate per row and task: nothing is joined or shuffled.  Among
    equally good target rows the smallest by column text wins.
    """
    if len(missing) > 100:
        raise ValueError("nearest_rows serves a report's few rows; each costs an aggregate")
    best = []
    for i, row in enumerate(missing):
        score = reduce(lambda a, b: a + b, [(col(n) == F.lit(row[n])).cast("int") for n in columns])
        best.append(F.min(F.struct((-score).alias("s"), *[col(n).alias(f"v{k}") for k, n in enumerate(columns)])).alias(f"b{i}"))
    rows = [
        F.struct(
            F.lit(i + 1).alias("mismatch"),
            (-F.col(f"b{i}.s")).alias("matched_columns"),
            *[F.lit(row[n]).alias(f"s{k}") for k, n in enumerate(columns)],
            *[F.col(f"b{i}.v{k}").alias(f"t{k}") for k in range(len(columns))],
        )
        for i, row in enumerate(missing)
    ]
    return target.agg(*best).select(F.inline(F.array(*rows)))


def _ordinals(c: Comparison, orders: Sequence[str]) -> list[int]:
    """Places of a few rows in the sample's order, counted rather than sorted."""
    before = [F.sum(F.when(F.col(ORDER) < o, F.col("copies")).otherwise(0)).alias(f"o{i}") for i, o in enumerate(orders)]
    return [n + 1 for n in c.sampled().agg(*before).first()]


DISCREPANCY_SCHEMA = (
    "row_index bigint, column_name string, source_value string, target_value string, "
    "matched_columns int, compared_columns int"
)


def discrepancy_report(
    c: Comparison, rows: int = REPORT_ROWS, columns: int | None = REPORT_COLUMNS, differing_first: bool = False
) -> DataFrame:
    """First mismatched rows against their nearest target rows, column by column.

    A limited number of ``columns`` are the first ones, or those that differ first.
    """
    spark = c.source.sparkSession
    missing = first_mismatches(c, rows)
    if not missing:
        return spark.createDataFrame([], DISCREPANCY_SCHEMA)
    places = _ordinals(c, [r[ORDER] for r in missing])
    nearest = nearest_rows(missing, c.target, c.columns)
    place = F.element_at(F.array(*[F.lit(p).cast("bigint") for p in places]), F.col("mismatch"))
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("column_name"), F.col(f"s{k}").alias("source_value"), F.col(f"t{k}").alias("target_value"))
            for k, n in enumerate(c.columns)
        ]
    )
    if columns is not None:
        differs = lambda cell: ~cell["source_value"].eqNullSafe(cell["target_value"])
        if differing_first:
            cells = F.concat(F.filter(cells, differs), F.filter(cells, lambda cell: ~differs(cell)))
        cells = F.slice(cells, 1, columns)
    return nearest.select(
        place.alias("row_index"), F.inline(cells), "matched_columns", F.lit(len(c.columns)).alias("compared_columns")
    )


def side_samples(c: Comparison, rows: int = REPORT_EXAMPLES, columns: int | None = REPORT_COLUMNS) -> DataFrame:
    """The first rows of both sides in hash order, cell by cell, and how many rows of that side follow.

    Each task sends its first rows only.  Equal rows have one hash, so where both
    sides hold the same rows their samples are the same.
    """
    names = c.columns[:columns]
    sides = []
    for side, df, count in (("source", c.source, c.source_count), ("target", c.target, c.target_count)):
        row = F.struct(ORDER, *[col(n).alias(f"v{k}") for k, n in enumerate(names)])
        first = df.orderBy(ORDER).limit(rows).agg(F.array_sort(F.collect_list(row)).alias("rows")).select(F.posexplode("rows").alias("place", "r"))
        cells = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(f"r.v{k}").alias("value")) for k, n in enumerate(names)])
        more = F.lit(max(0, count - rows)).cast("bigint").alias("more_rows")
        sides.append(first.select(F.lit(side).alias("side"), (F.col("place") + 1).alias("place"), F.inline(cells), more))
    return sides[0].unionAll(sides[1])


def column_overview(c: Comparison, columns: int | None = REPORT_ANALYSED) -> DataFrame:
    """Per column the distinct values of both sides and those they share, from sketches: no value is shuffled.

    Exact below 4,096 distinct values, else within the sketches' bound; ``column_discrepancies`` is exact at any size.
    """
    names = [col(n) for n in c.columns[:columns]]
    sides = [column_sketches(df.select(*names)) for df in (c.source, c.target)]
    return sketch_counts(*sides).select(
        "column_name", F.col("past_distinct").alias("source_distinct"), F.col("load_distinct").alias("target_distinct"),
        "common_values", F.col("gone_values").alias("source_only"), F.col("new_values").alias("target_only"),
    )


def _short(value: str) -> str:
    return value if len(value) <= REPORT_VALUE else value[:REPORT_VALUE] + "..."


def discrepancy_text(c: Comparison, limit: int = REPORT_TEXT) -> str:
    """The report as one text for a history row, cut at the column's limit.

    Differing rows against their nearest, how many differ beyond these, the first
    rows of both sides, and the distinct values of the first columns.
    """
    by_row: dict[int, list[str]] = {}
    for r in discrepancy_report(c, differing_first=True).collect():
        head = f"Row {r['row_index']} (best target match {r['matched_columns']}/{r['compared_columns']} columns): "
        cells = by_row.setdefault(r["row_index"], [head])
        cells.append(f"{r['column_name']}(src:'{r['source_value'][:100]}' vs tgt:'{r['target_value'][:100]}')")
    parts = [cells[0] + ", ".join(cells[1:]) for _, cells in sorted(by_row.items())]
    more = c.sampled().filter(F.col("found") == 0).count() - len(by_row)
    if more > 0:
        parts.append(f"... and {more} more rows that differ")
    samples: dict[str, dict[int, list[str]]] = {}
    further = {}
    for r in side_samples(c).collect():
        samples.setdefault(r["side"], {}).setdefault(r["place"], []).append(f"{r['column_name']}='{_short(r['value'])}'")
        further[r["side"]] = r["more_rows"]
    for side, rows in samples.items():
        parts.append(f"First {side} rows: " + "; ".join(", ".join(cells) for _, cells in sorted(rows.items())))
        if further[side]:
            parts.append(f"... and {further[side]} more {side} rows")
    overview = {r["column_name"]: r for r in column_overview(c).collect()}
    for name in c.columns[:REPORT_ANALYSED]:
        r = overview[name]
        parts.append(
            f"Column {name}: {r['source_distinct']} values in the source, {r['target_distinct']} in the target, "
            f"{r['common_values']} in both, {r['source_only']} in the source only, {r['target_only']} in the target only."
        )
    text = " ".join(parts)
    return text if len(text) <= limit else text[:limit] + "... (truncated)"


def column_discrepancies(
    source: DataFrame, target: DataFrame, columns: Sequence[str], examples: int = REPORT_EXAMPLES
) -> DataFrame:
    """Per column: distinct values on each side, shared, one-sided, with examples.

    Values are counted per (column, value) with pre-aggregation; examples come
    from a ranked window whose limit Spark applies inside every map task.
    """

    def values(df: DataFrame, s: int, t: int) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}
        cells = [
            F.struct(F.lit(n).alias("column_name"), compare_text(col(n), types[n]).alias("value")) for n in columns
        ]
        return df.select(F.inline(F.array(*cells)), F.lit(s).alias("s"), F.lit(t).alias("t"))

    distinct = (
        values(source, 1, 0)
        .unionAll(values(target, 0, 1))
        .groupBy("column_name", "value")
        .agg(F.max("s").alias("s"), F.max("t").alias("t"))
    )
    s, t = F.col("s"), F.col("t")
    counts = distinct.groupBy("column_name").agg(
        F.sum("s").cast("bigint").alias("source_distinct"),
        F.sum("t").cast("bigint").alias("target_distinct"),
        F.count_if(s + t == 2).alias("common_values"),
        F.count_if(t == 0).alias("source_only"),
        F.count_if(s == 0).alias("target_only"),
    )
    window = Window.partitionBy("column_name", "s").orderBy("value")
    listed = (
        distinct.filter(s + t == 1)
        .withColumn("__rank", F.row_number().over(window))
        .filter(F.col("__rank") <= examples)
        .groupBy("column_name")
        .agg(
            F.array_join(F.array_sort(F.collect_list(F.when(s == 1, F.col("value")))), ", ").alias("source_only_examples"),
            F.array_join(F.array_sort(F.collect_list(F.when(s == 0, F.col("value")))), ", ").alias("target_only_examples"),
        )
    )
    empty = F.lit("")
    return counts.join(listed, "column_name", "left").withColumns(
        {n: F.coalesce(F.col(n), empty) for n in ("source_only_examples", "target_only_examples")}
    )


def run_checks(
    source: DataFrame,
    target: DataFrame,
    table: str,
    sample_percentage: float = 10.0,
    mapping: dict[str, str] | None = None,
    exclude: Sequence[str] = SYSTEM_COLUMNS,
    source_file: str | None = None,
    row_count: bool = True,
    content: bool = True,
    details: bool = True,
    count_copies: bool = False,
) -> DataFrame:
    """The enabled checks as check rows.  An error becomes a SYSTEM_ERROR row.

    Check rows are evaluated here (one row each), so what is returned is small
    and later writes do not run the checks again.
    """
    spark = target.sparkSession
    found: list[Row] = []
    try:
        comparison, refusal = None, None
        if content:
            try:
                comparison = prepare_comparison(source, target, sample_percentage, mapping, exclude, source_file)
            except NothingToCompare as e:
                refusal = e
        known = comparison or refusal
        if row_count and known is not None and known.source_count is not None:
            # The match already counted both sides.
            counts = spark.range(1).select(
                F.lit(known.source_count).cast("bigint").alias("s"), F.lit(known.target_count).cast("bigint").alias("t")
            )
            found += _row_count_row(counts, table, source_file).collect()
        elif row_count:
            found += row_count_check(source, target, table, source_file).collect()
        if refusal is not None:
            found += failed_check(
                spark, CONTENT, table, str(refusal), source_count=refusal.source_count, target_count=refusal.target_count
            ).collect()
        elif comparison is not None:
            row = content_check(comparison, table, count_copies).first()
            if details and row["status"] == FAILED:
                text = (row["error_message"] + " " + discrepancy_text(comparison)).strip()
                row = Row(**{**row.asDict(), "error_message": text})
            found.append(row)
            comparison.forget()
    except Exception as e:
        found += failed_check(spark, SYSTEM_ERROR, table, str(e)).collect()
    return spark.createDataFrame([tuple(r[f.name] for f in CHECK_SCHEMA.fields) for r in found], CHECK_SCHEMA)
