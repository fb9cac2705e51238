"""The registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.common import tuned
from tideline.llm.decontaminate import contaminated
from tideline.llm.exact_dedup import exact_dedup
from tideline.llm.filter_audit import filter_audit
from tideline.llm.html_text import main_text
from tideline.llm.jaccard import jaccard_classes
from tideline.llm.language_id import identify
from tideline.llm.lm_score import score_texts
from tideline.llm.packing import pack
from tideline.llm.quality import held_out, score_quality, training_labels
from tideline.llm.ranked_search import ranked_search
from tideline.llm.suffix_dedup import suffix_dedup
from tideline.llm.token_counts import token_counts
from tideline.llm.url_filter import url_verdicts
from tideline.suite.registry import Query, table

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = lambda spark, folder: fn(tuned(spark), folder)
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query(r"""
  WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
  g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
      row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) = 1 AS kept FROM d)
  SELECT doc_id, keep_id, group_size, kept, sha256(norm) AS text_sha256 FROM g
""")
def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


@query(r"""
  WITH a AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
  b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM a),
  r(verdict, rule, h, p) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
    ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/'))
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
  FROM (SELECT b.*, r.rule, r.verdict FROM b LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
  GROUP BY page_id, host, path
""")
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(table(spark, folder, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


@query()
def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


@query()
def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")).withColumnRenamed("id", "doc_id")


@query()
def op1_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scores = score_quality(table(spark, folder, "documents"), training_labels(table(spark, folder, "labels")))
    return scores.select(
        F.col("id").alias("doc_id"), held_out("id", 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query()
def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).withColumnRenamed("id", "doc_id")


@query(r"""
  WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
  g AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END)) AS g FROM w),
  n AS (SELECT doc_id, count(g) AS n FROM w LEFT JOIN g USING (doc_id) GROUP BY doc_id),
  pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
  e AS (SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 90 * (a.n + b.n - i)),
  r(doc_id, root) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id)
  SELECT n.doc_id, n.n AS n_shingles, c.component_id FROM n JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
""")
def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_classes(table(spark, folder, "documents"), 3, 90).withColumnRenamed("id", "doc_id")


@query()
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scores = score_texts(docs, ~held_out("doc_id", 10, 0), public_tokenizers.path("piece_bpe_32k.model"))
    return scores.select(F.col("id").alias("doc_id"), held_out("id", 10, 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "mixed_score")


@query()
def op9_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages")).withColumnRenamed("id", "page_id")


@query()
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup(table(spark, folder, "documents")).drop("kept").withColumnRenamed("id", "doc_id")


@query(r"""
  WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
  w AS (SELECT *, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
  l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
  m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
      CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
      || CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) THEN 'C' ELSE '' END
      || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
    FROM w LEFT JOIN l USING (doc_id)),
  f AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM m GROUP BY part, fails),
  c(c) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
  o AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order FROM c a, c b, c c, c d, c e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
  s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before FROM o, generate_series(1, 5) r(step)),
  h AS (SELECT filter_order, step::INTEGER AS step, own, f.*, contains(fails, own) AS hit, length(translate(before, fails, '')) < length(before) AS gone FROM s, f),
  r AS (SELECT part, filter_order, step, any_value(own) AS own, sum(n) FILTER (NOT hit AND NOT gone) AS kept, sum(n) FILTER (hit AND NOT gone) AS removed,
      sum(n) FILTER (hit AND gone) AS redundant, sum(n) FILTER (fails = own) AS unique_fails, sum(g) FILTER (hit AND NOT gone) AS good_lost,
      sum(x) FILTER (hit AND NOT gone) AS toxic_lost FROM h GROUP BY part, filter_order, step),
  t AS (SELECT part, own, sum(removed) AS shapley FROM r GROUP BY part, own)
  SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    coalesce(shapley, 0)::BIGINT AS shapley FROM r JOIN t USING (part, own)
""")
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query(r"""
  WITH t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t,
      row_number() OVER () AS r FROM documents),
  d AS (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM t),
  c AS (SELECT count(*)::BIGINT AS nn, sum(len(t))::BIGINT AS ll FROM t WHERE len(t) > 0),
  tf AS (SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM d GROUP BY ALL),
  w AS (SELECT term, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, c GROUP BY term, nn),
  q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
  qt AS (SELECT item_id, term, count(*)::BIGINT AS k FROM q GROUP BY ALL),
  p AS (SELECT term, r, doc_id, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))) AS part FROM tf JOIN w USING (term), c),
  s AS (SELECT item_id, r, doc_id, sum(k * part)::BIGINT AS score FROM qt JOIN p USING (term) GROUP BY ALL),
  o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
  SELECT * FROM o WHERE rank <= 20
""")
def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark")).withColumnRenamed("id", "doc_id")


@query()
def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    found = identify(table(spark, folder, "documents"), ~held_out("doc_id", 3, 1))
    return found.select(F.col("id").alias("doc_id"), held_out("id", 3, 1).alias("held_out"), "lang_pred", "score")
