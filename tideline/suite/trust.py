"""Tables that stay whole when something fails, and every difference between two of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.appended import append_batch, appended_key_violations
from tideline.operators.hash_tree import comparable, read_tree, table_differences, write_tree
from tideline.operators.nearest import nearest_for_all
from tideline.operators.reconcile import column_discrepancies
from tideline.operators.sketches import append_sketches, error_bound, sketch_drift
from tideline.operators.transform import CleaningOptions
from tideline.plans.run import run_report, run_table, run_tables
from tideline.session import scratch_dir
from tideline.sinks import versions
from tideline.sinks.history import read_history
from tideline.sinks.tables import write_table
from tideline.streaming.ingest import append_stream, counted_append, stream_files, without_repeats
from tideline.suite.registry import ORDER_COLUMNS, ORDER_COPY, ORDER_TEXT, from_sql, query, table


def _totals(df: DataFrame, step: str) -> DataFrame:
    total = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
    return df.agg(F.lit(step).alias("step"), F.count("*").alias("n_rows"), total.alias("total"))


@query(
    """WITH o AS (SELECT CAST(o_totalprice AS DECIMAL(18,2)) AS p, o_orderkey AS k FROM orders),
    a AS (SELECT count(*) AS n, CAST(sum(p) AS DOUBLE) AS t FROM o), b AS (SELECT count(*) AS n, CAST(sum(p) AS DOUBLE) AS t FROM o WHERE k % 2 = 0)
    SELECT 'written' AS step, n AS n_rows, t AS total FROM a UNION ALL SELECT 'after a write that died', n, t FROM a
    UNION ALL SELECT 'replaced', n, t FROM b UNION ALL SELECT 'rolled back', n, t FROM a"""
)
def replace_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """A write that dies leaves the old table; one that ends replaces it; the old one can be had back."""
    path = f"{scratch_dir(spark, 'versions')}/orders"
    orders = table(spark, folder, "orders")
    versions.replace_table(orders, path)
    steps = [_totals(versions.read_version(spark, path), "written")]
    dies = F.when(F.col("o_orderkey") % 7 == 3, F.raise_error(F.lit("the source went away"))).otherwise(F.col("o_custkey"))
    try:
        versions.replace_table(orders.withColumn("o_custkey", dies.cast("long")), path)
    except Exception as e:
        if "went away" not in str(e):
            raise
    steps.append(_totals(versions.read_version(spark, path), "after a write that died"))
    versions.replace_table(orders.where("o_orderkey % 2 = 0"), path)
    steps.append(_totals(versions.read_version(spark, path), "replaced"))
    versions.rollback(spark, path)
    steps.append(_totals(versions.read_version(spark, path), "rolled back"))
    return steps[0].union(steps[1]).union(steps[2]).union(steps[3])


_COPIES = "SELECT * FROM ({}) UNION ALL SELECT * FROM ({}) WHERE CAST(o_custkey AS BIGINT) % {} = 0"


@query(
    f"""WITH s AS ({_COPIES.format(ORDER_TEXT, ORDER_TEXT, 5)}), t AS ({_COPIES.format(ORDER_COPY, ORDER_COPY, 10)}),
    u AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, trim(o_orderpriority) AS o_orderpriority, 1 AS a, 0 AS b FROM s
      UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, trim(o_orderpriority), 0, 1 FROM t)
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, CAST(sum(a) AS BIGINT) AS source_copies, CAST(sum(b) AS BIGINT) AS target_copies
    FROM u GROUP BY ALL HAVING sum(a) <> sum(b)"""
)
def tree_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Every row that is missing, surplus or there in another number, with a tree kept for the source."""
    source = from_sql(spark, folder, _COPIES.format(ORDER_TEXT, ORDER_TEXT, 5), "orders")
    target = from_sql(spark, folder, _COPIES.format(ORDER_COPY, ORDER_COPY, 10), "orders")
    path = scratch_dir(spark, "tree")
    write_tree(comparable(source, [(c, c) for c in ORDER_COLUMNS]), path)
    return table_differences(source, target, source_tree=read_tree(spark, path))


@query(
    """SELECT 'EMPTY' AS table_name, TRUE AS loaded, TRUE AS quality_passed, CAST(0 AS BIGINT) AS total_rows, CAST(NULL AS VARCHAR) AS failed_stage FROM (SELECT count(*) FROM orders)
    UNION ALL SELECT 'TYPED', TRUE, TRUE, 0, NULL UNION ALL SELECT 'FULL', TRUE, TRUE, count(*), NULL FROM orders"""
)
def run_leaves_nothing(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaning steps that drop every row leave an empty table, not a failed run."""
    base = scratch_dir(spark, "nothing")
    sql = "SELECT o_orderkey, o_orderstatus, CAST(NULL AS STRING) AS note FROM orders"
    write_table(from_sql(spark, folder, sql, "orders"), f"{base}/in")
    specs = {
        "EMPTY": {"source_type": "parquet", "source_file_path": "in", "target_table": "EMPTY"},
        "TYPED": {"source_type": "parquet", "source_file_path": "in", "target_table": "TYPED", "column_types": {"o_orderkey": "integer"}, "versioned": True},
    }
    cleaning = CleaningOptions(null_strategy="drop_rows")
    runs = run_tables(spark, specs, base, base, cleaning=cleaning)
    runs.append(run_table(spark, {**specs["EMPTY"], "target_table": "FULL"}, base, base))
    return run_report(spark, runs).select("table_name", "loaded", "quality_passed", "total_rows", "failed_stage")


@query(
    f"""WITH s AS ({ORDER_TEXT}), t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, trim(o_orderpriority) AS o_orderpriority FROM ({ORDER_COPY})),
    m AS (SELECT * FROM s EXCEPT SELECT * FROM t),
    p AS (SELECT m.*, t.o_orderkey AS k, t.o_custkey AS c, t.o_orderstatus AS st, t.o_totalprice AS p, t.o_orderpriority AS pr,
        (m.o_orderkey = t.o_orderkey)::INTEGER + (m.o_custkey = t.o_custkey)::INTEGER + (m.o_orderstatus = t.o_orderstatus)::INTEGER
        + (m.o_totalprice = t.o_totalprice)::INTEGER + (m.o_orderpriority = t.o_orderpriority)::INTEGER AS matched_columns FROM m, t)
    SELECT matched_columns, o_orderkey AS source_o_orderkey, k AS target_o_orderkey, c AS target_o_custkey, st AS target_o_orderstatus, p AS target_o_totalprice,
      pr AS target_o_orderpriority FROM p
    QUALIFY row_number() OVER (PARTITION BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority ORDER BY matched_columns DESC, k, c, st, p, pr) = 1"""
)
def nearest_for_all_orders(spark: SparkSession, folder: str) -> DataFrame:
    """For every order that the copy lacks, the row of the copy with most equal columns."""
    pairs = [(c, c) for c in ORDER_COLUMNS]
    source, target = (comparable(from_sql(spark, folder, sql, "orders"), pairs).drop("__order") for sql in (ORDER_TEXT, ORDER_COPY))
    found = nearest_for_all(source.join(target, ORDER_COLUMNS, "left_anti"), target, ORDER_COLUMNS)
    return found.select("matched_columns", "source_o_orderkey", *[f"target_{c}" for c in ORDER_COLUMNS])


@query(
    """SELECT o_orderkey, count(*) AS n_rows, 'kept_key' AS violation FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 11 = 0 GROUP BY o_orderkey
    UNION ALL SELECT o_orderkey, CAST(2 AS BIGINT), 'duplicate_key' FROM orders WHERE o_orderkey % 3 = 2 AND o_orderkey % 13 = 0 GROUP BY o_orderkey"""
)
def pk_check_appended(spark: SparkSession, folder: str) -> DataFrame:
    """A third batch repeats keys of the first and some of its own; old keys are read only where the filters hit."""
    path = f"{scratch_dir(spark, 'batches')}/orders"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    for batch in ("0", "1"):
        append_batch(spark, orders.where(f"o_orderkey % 3 = {batch}"), path, ["o_orderkey"], batch)
    own = orders.where("o_orderkey % 3 = 2")
    third = own.union(own.where("o_orderkey % 13 = 0")).union(orders.where("o_orderkey % 3 = 0 AND o_orderkey % 11 = 0"))
    return appended_key_violations(spark, third, path, ["O_ORDERKEY"])


@query(
    """SELECT count(DISTINCT event_id) AS n_events, CAST(0 AS BIGINT) AS repeated FROM events"""
)
def stream_dedupe_restart(spark: SparkSession, folder: str) -> DataFrame:
    """Events that come again in a later file are dropped, though the stream was stopped in between."""
    files, target, log = (scratch_dir(spark, n) for n in ("drop", "stream", "stream-log"))
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type")
    for part in ("event_id % 3 <> 0", "event_id % 2 = 0", "true"):
        events.where(part).write.mode("append").option("header", True).csv(files)
        append_stream(without_repeats(stream_files(spark, files, events.columns, files_per_batch=100), ["event_id"]), target, log, timeout=600)
    rows = spark.read.parquet(target)
    return rows.agg(F.count("*").alias("n_events"), (F.count("*") - F.countDistinct("event_id")).alias("repeated"))


@query(
    """SELECT 'EVENTS' AS table_name, 'STREAM_COUNT' AS check_type, 'PASSED' AS status, CAST(4 AS BIGINT) AS n_batches, CAST(count(*) AS BIGINT) AS source_count,
    CAST(count(*) FILTER (event_type <> 'click') AS BIGINT) AS target_count FROM events"""
)
def stream_counts_by_file(spark: SparkSession, folder: str) -> DataFrame:
    """One history row for each file that streamed in, counted while it passed."""
    files, target, log, history = (scratch_dir(spark, n) for n in ("drop", "stream", "stream-log", "history"))
    events = table(spark, folder, "events").select("event_id", "event_type")
    events.repartition(4).write.option("header", True).csv(files)
    stream = stream_files(spark, files, events.columns, files_per_batch=1)
    counted_append(stream, lambda rows: rows.where("event_type <> 'click'"), target, log, "EVENTS", history, timeout=600)
    total = lambda c: F.sum(c).alias(c.lower())
    rows = read_history(spark, history, "EVENTS").groupBy(*[F.col(c).alias(c.lower()) for c in ("TABLE_NAME", "CHECK_TYPE", "STATUS")])
    return rows.agg(F.countDistinct("ERROR_MESSAGE").alias("n_batches"), total("SOURCE_COUNT"), total("TARGET_COUNT"))


@query(
    """SELECT 'first' AS run, 'check' AS failed_stage, CAST(NULL AS VARCHAR) AS resumed_after, TRUE AS loaded, FALSE AS quality_passed, count(*) AS total_rows FROM orders
    UNION ALL SELECT 'second', NULL, 'load', TRUE, TRUE, count(*) FROM orders
    UNION ALL SELECT 'third', NULL, NULL, TRUE, TRUE, count(*) FROM orders"""
)
def run_resumed(spark: SparkSession, folder: str) -> DataFrame:
    """A run that failed in its checks goes on after the load; one that ended well starts anew."""
    base = scratch_dir(spark, "resumed")
    table(spark, folder, "orders").write.parquet(f"{base}/in")
    spec = {"source_type": "parquet", "source_file_path": "in", "target_table": "T", "normalize_dates": False}
    reports = []
    for name, history in (("first", f"{base}/in/_SUCCESS/history"), ("second", f"{base}/history"), ("third", f"{base}/history")):
        (run,) = run_tables(spark, {"t": spec}, base, f"{base}/out", history_path=history, ledger_dir=f"{base}/ledger")
        reports.append((name, run.failed_stage, run.resumed_after, run.loaded, bool(run.quality_passed) and run.failed_stage is None, run.total_rows))
    return spark.createDataFrame(reports, "run string, failed_stage string, resumed_after string, loaded boolean, quality_passed boolean, total_rows long")


_LOAD = "SELECT o_orderkey, o_custkey, CASE WHEN CAST(o_orderkey AS BIGINT) % 5 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, upper(o_orderpriority) AS o_orderpriority FROM ({}) WHERE CAST(o_orderkey AS BIGINT) % 3 = 2"
_OF_COLUMN = """SELECT '{0}' AS column_name, (SELECT count(DISTINCT {0}) FROM p) AS past_distinct, (SELECT count(DISTINCT {0}) FROM l) AS load_distinct,
    (SELECT count(*) FROM (SELECT {0} FROM p INTERSECT SELECT {0} FROM l)) AS common_values, (SELECT count(*) FROM (SELECT {0} FROM l EXCEPT SELECT {0} FROM p)) AS new_values, TRUE AS within_bound"""


@query(
    f"""WITH p AS (SELECT * FROM ({ORDER_TEXT}) WHERE CAST(o_orderkey AS BIGINT) % 3 < 2), l AS ({_LOAD.format(ORDER_TEXT)})
    {" UNION ALL ".join(_OF_COLUMN.format(c) for c in ORDER_COLUMNS)}"""
)
def column_sketch_drift(spark: SparkSession, folder: str) -> DataFrame:
    """What a third load brings that two before it had not, from kept sketches, held against exact counts."""
    path = f"{scratch_dir(spark, 'sketches')}/orders"
    orders = from_sql(spark, folder, ORDER_TEXT, "orders")
    key = F.col("o_orderkey").cast("bigint") % 3
    loads = [orders.where(key == 0), orders.where(key == 1), from_sql(spark, folder, _LOAD.format(ORDER_TEXT), "orders")]
    for name, rows in zip(("first", "second", "third"), loads):
        append_sketches(rows, path, "ORDERS", name)
    told = sketch_drift(spark, path, "ORDERS", "third")
    counts = ("past_distinct", "load_distinct", "common_values", "new_values")
    exact = column_discrepancies(loads[0].union(loads[1]), loads[2], ORDER_COLUMNS).select(
        "column_name", *[F.col(a).alias(f"exact_{b}") for a, b in zip(("source_distinct", "target_distinct", "common_values", "target_only"), counts)]
    )
    within = F.lit(True)
    for c in counts:
        within &= F.abs(F.col(c) - F.col(f"exact_{c}")) <= F.col("all_distinct") * error_bound()
    both = exact.join(told, "column_name", "left")
    return both.select("column_name", *[F.col(f"exact_{c}").alias(c) for c in counts], F.coalesce(within, F.lit(False)).alias("within_bound"))
