"""Value conversion, rejects and column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.convert import to_flag, to_float, to_integer, to_text
from tideline.functions.dates import parse_any, to_moment
from tideline.operators.profile import conversion_stats, field_spec, type_profile, width_profile
from tideline.operators.rejects import convert_table
from tideline.session import scratch_dir
from tideline.sinks.tables import read_good, read_rejected, write_with_rejects
from tideline.sources.fixed_width import legacy_table
from tideline.suite.registry import from_sql, query, table

STRING, DOUBLE = T.StringType(), T.DoubleType()

DIRTY = """SELECT o_orderkey,
  CASE o_orderkey % 7 WHEN 0 THEN 'none' WHEN 1 THEN CAST(o_custkey AS VARCHAR) || '.0' WHEN 2 THEN CAST(o_custkey AS VARCHAR) || '.9'
    WHEN 3 THEN '1e3' WHEN 4 THEN '9007199254740993' WHEN 5 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS whole,
  CASE o_orderkey % 5 WHEN 0 THEN 'nan' WHEN 1 THEN 'x1' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
  CASE o_orderkey % 6 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'Yes' WHEN 2 THEN 'y' WHEN 3 THEN '1' WHEN 4 THEN NULL ELSE o_orderstatus END AS flag
  FROM orders"""
_WHOLE = "COALESCE(TRY_CAST(CASE WHEN regexp_matches(whole, '^[0-9]+$') THEN whole END AS BIGINT), CAST(trunc(TRY_CAST(whole AS DOUBLE)) AS BIGINT))"
_PRICE = "CASE WHEN price <> 'nan' THEN TRY_CAST(price AS DOUBLE) END"


@query(
    f"""SELECT o_orderkey, {_WHOLE} AS whole, {_PRICE} AS price,
      CASE WHEN flag IS NULL THEN NULL WHEN lower(flag) IN ('true', '1', 'yes', 'y') THEN 1 ELSE 0 END AS flag FROM ({DIRTY})"""
)
def convert_values(spark: SparkSession, folder: str) -> DataFrame:
    df = from_sql(spark, folder, DIRTY, "orders")
    return df.select(
        "o_orderkey",
        to_integer(F.col("whole"), STRING).alias("whole"),
        to_float(F.col("price"), STRING).alias("price"),
        to_flag(F.col("flag"), STRING).alias("flag"),
    )


@query(
    """SELECT doc_id, substring(text, 1, 4000) AS text,
      CASE WHEN doc_id % 4 = 0 THEN '' WHEN doc_id % 4 = 1 THEN 'Infinity' WHEN doc_id % 4 = 2 THEN '-Infinity'
        ELSE CAST(n_chars AS VARCHAR) END AS number,
      CASE WHEN n_chars % 2 = 0 THEN CAST(n_chars // 2 AS VARCHAR) ELSE CAST(n_chars // 2 AS VARCHAR) || '.5' END AS half
    FROM documents"""
)
def convert_text(spark: SparkSession, folder: str) -> DataFrame:
    odd = F.expr(
        "CASE doc_id % 4 WHEN 0 THEN double('nan') WHEN 1 THEN double('inf') WHEN 2 THEN double('-inf') ELSE double(n_chars) END"
    )
    return table(spark, folder, "documents").select(
        "doc_id",
        to_text(F.col("text"), STRING).alias("text"),
        to_text(odd, DOUBLE).alias("number"),
        to_text(F.col("n_chars") / 2.0, DOUBLE).alias("half"),
    )


# Every value pattern, an unreadable value, and a day no month has.
# A single value's date forms in the two engines' notations.
_FORMS = [
    ("yyyy-MM-dd", "%Y-%m-%d"),
    ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("yyyy-MM-dd HH:mm:ss.SSSSSS", "%Y-%m-%d %H:%M:%S.%f"),
    ("MM/dd/yyyy", "%m/%d/%Y"),
    ("MM/dd/yyyy HH:mm:ss", "%m/%d/%Y %H:%M:%S"),
    ("dd/MM/yyyy", "%d/%m/%Y"),
    ("dd/MM/yyyy HH:mm:ss", "%d/%m/%Y %H:%M:%S"),
    ("dd-MM-yyyy", "%d-%m-%Y"),
    ("dd-MM-yyyy HH:mm:ss", "%d-%m-%Y %H:%M:%S"),
]


def _forms_case(fn: str, which: int) -> str:
    cases = " ".join(f"WHEN {i} THEN {fn}(ts, '{f[which]}')" for i, f in enumerate(_FORMS))
    return f"CASE event_id % 11 {cases} WHEN 9 THEN 'soon' ELSE '02/30/2024' END"


_PARSE = "COALESCE(" + ", ".join(f"try_strptime(d, '{f[1]}')" for f in _FORMS) + ")"


@query(
    f"""SELECT event_id, strftime({_PARSE}, '%Y-%m-%d %H:%M:%S.%f') AS moment, {_PARSE} IS NULL AS unread,
      strftime(to_timestamp(event_id) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS epoch,
      strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS midnight
    FROM (SELECT event_id, ts, {_forms_case('strftime', 1)} AS d FROM events)"""
)
def parse_dates_any(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("event_id", "ts", F.expr(_forms_case("date_format", 0)).alias("d"))
    moment, clock = parse_any(F.col("d")), "yyyy-MM-dd HH:mm:ss"
    return events.select(
        "event_id",
        F.date_format(moment, clock + ".SSSSSS").alias("moment"),
        moment.isNull().alias("unread"),
        F.date_format(to_moment(F.col("event_id"), T.LongType()), clock).alias("epoch"),
        F.date_format(to_moment(F.to_date("ts"), T.DateType()), clock).alias("midnight"),
    )


TARGETS = {"whole": "integer", "price": "float", "flag": "flag"}
_BAD_WHOLE = f"whole IS NOT NULL AND {_WHOLE} IS NULL"
_BAD_PRICE = f"price IS NOT NULL AND {_PRICE} IS NULL"


def _split(spark: SparkSession, folder: str) -> str:
    """One pass writes good and rejected rows side by side."""
    path = scratch_dir(spark, "split")
    write_with_rejects(convert_table(from_sql(spark, folder, DIRTY, "orders"), TARGETS), path)
    return path


@query(
    f"""SELECT o_orderkey, {_WHOLE} AS whole, {_PRICE} AS price,
      CASE WHEN flag IS NULL THEN NULL WHEN lower(flag) IN ('true', '1', 'yes', 'y') THEN 1 ELSE 0 END AS flag
    FROM ({DIRTY}) WHERE NOT ({_BAD_WHOLE}) AND NOT ({_BAD_PRICE})"""
)
def good_rows_loaded(spark: SparkSession, folder: str) -> DataFrame:
    return read_good(spark, _split(spark, folder))


@query(
    f"""SELECT concat_ws(';', CASE WHEN {_BAD_WHOLE} THEN 'whole:not_integer' END, CASE WHEN {_BAD_PRICE} THEN 'price:not_float' END)
        AS reasons, o_orderkey, whole, price FROM ({DIRTY}) WHERE ({_BAD_WHOLE}) OR ({_BAD_PRICE})"""
)
def rejected_rows_kept(spark: SparkSession, folder: str) -> DataFrame:
    """Rejects keep their original values, whatever these were."""
    rejected = read_rejected(spark, _split(spark, folder))
    row = F.from_json("_source_row", "o_orderkey bigint, whole string, price string")
    return rejected.select(F.col("_reject_reasons").alias("reasons"), row.alias("r")).select("reasons", "r.*")


def _width_sql(tables: dict[str, list[str]]) -> str:
    parts = [f"SELECT '{c}' AS column_name, max(length({c})) AS m FROM {t}" for t, cs in tables.items() for c in cs]
    wide = "CAST(m AS DOUBLE)"
    room = f"CASE WHEN m <= 50 THEN 255.0 WHEN m <= 100 THEN {wide} * 2 WHEN m <= 500 THEN {wide} * 1.5 ELSE {wide} * CAST(1.2 AS DOUBLE) END"
    width = f"CASE WHEN m IS NULL THEN 255 ELSE CAST(floor(least(greatest({room}, 1000.0), 4000.0)) AS BIGINT) END"
    return f"SELECT column_name, m AS max_length, {width} AS recommended_width, greatest({width}, 1000) AS declared_width FROM ({' UNION ALL '.join(parts)})"


@query(_width_sql({"documents": ["text", "lang", "source"], "pages": ["url", "html"], "part": ["p_name", "p_brand", "p_type"]}))
def width_profiles(spark: SparkSession, folder: str) -> DataFrame:
    profiles = [width_profile(table(spark, folder, name)) for name in ("documents", "pages", "part")]
    return profiles[0].unionAll(profiles[1]).unionAll(profiles[2])


@query(
    """SELECT * FROM (VALUES (1, 'l_orderkey', 'N', 10, 0), (5, 'l_shipdate', 'D', 8, 0), (3, 'l_quantity', 'N', 15, 2), (4, 'late', 'L', 1, 0))
        AS f(position, field_name, field_type, length, decimals)
    UNION ALL SELECT 2, 'l_returnflag', 'C', CAST(least(greatest(max(length(l_returnflag)), 10), 254) AS INTEGER), 0 FROM lineitem
    UNION ALL SELECT 6, 'text', 'C', CAST(least(greatest(max(length(text)), 10), 254) AS INTEGER), 0 FROM documents"""
)
def field_specs(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_quantity", (F.col("l_tax") > 0.05).alias("late"), "l_shipdate"
    )
    texts = field_spec(table(spark, folder, "documents").select("text")).withColumn("position", F.lit(6))
    return field_spec(lines).unionAll(texts)


_KIND = """CASE WHEN regexp_matches({c}, '^[+-]?[0-9]+$') THEN 'integer' WHEN TRY_CAST({c} AS DOUBLE) IS NOT NULL THEN 'decimal'
  WHEN try_strptime({c}, '%Y-%m-%d %H:%M:%S') IS NOT NULL THEN 'date' WHEN {c} IS NOT NULL THEN 'text' END"""
MIXED = """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
  CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN strf(ts) WHEN 2 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)
    WHEN 3 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS mixed FROM events"""
MIXED_SQL = MIXED.replace("strf(ts)", "strftime(ts, '%Y-%m-%d %H:%M:%S')")


def _profile_sql(column: str) -> str:
    kinds = ("integer", "decimal", "date", "text")
    counts = ", ".join(f"count(*) FILTER (k = '{k}') AS {k}_count" for k in kinds)
    return f"SELECT '{column}' AS column_name, count(k) AS non_null_count, {counts}, count(DISTINCT k) > 1 AS is_mixed FROM (SELECT {_KIND.format(c=column)} AS k FROM d)"


@query(f"WITH d AS ({MIXED_SQL}) " + " UNION ALL ".join(_profile_sql(c) for c in ("event_id", "event_type", "mixed")))
def type_profiles(spark: SparkSession, folder: str) -> DataFrame:
    sql = MIXED.replace("strf(ts)", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')")
    return type_profile(from_sql(spark, folder, sql, "events"))


@query(
    f"""WITH d AS ({MIXED_SQL}), m AS (SELECT {_KIND.format(c='mixed')} AS k, TRY_CAST(mixed AS DOUBLE) IS NOT NULL AS ok FROM d)
    SELECT 'event_id' AS column_name, 'integer' AS from_kind, 'integer' AS to_kind, count(*) AS n_values FROM d
    UNION ALL SELECT 'mixed', k, CASE WHEN ok THEN 'float' ELSE 'null' END, count(*) FROM m WHERE k IS NOT NULL GROUP BY k, ok"""
)
def conversion_counts(spark: SparkSession, folder: str) -> DataFrame:
    sql = MIXED.replace("strf(ts)", "date_format(ts, 'yyyy-MM-dd HH:mm:ss')")
    return conversion_stats(from_sql(spark, folder, sql, "events"), {"event_id": "integer", "mixed": "float"})


LEGACY = """SELECT o_orderkey, o_orderdate, CAST(o_orderdate AS DATE) AS day,
  CASE o_orderkey % 5 WHEN 0 THEN CAST(o_custkey AS VARCHAR) || '.00' WHEN 1 THEN '00' || CAST(o_custkey AS VARCHAR)
    WHEN 2 THEN ' ' WHEN 3 THEN ' ' || o_orderpriority || ' ' ELSE CAST(o_custkey AS VARCHAR) || '.25' END AS code FROM orders"""


@query(
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, strftime(o_orderdate, '%m/%d/%Y %I:%M %p') AS o_orderdate,
      strftime(day, '%Y-%m-%d') AS day,
      nullif(CASE WHEN code LIKE '%.00' THEN replace(code, '.00', '') ELSE trim(code) END, '') AS code, nullif(trim(code), '') AS kept FROM ({LEGACY})"""
)
def legacy_values(spark: SparkSession, folder: str) -> DataFrame:
    """One column renumbered on request; the same codes beside it keep their spelling."""
    df = from_sql(spark, folder, LEGACY, "orders").withColumn("kept", F.col("code"))
    return legacy_table(df, renumber=["code"])
