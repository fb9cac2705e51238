"""The pipeline's stages on a small corpus with planted cases, and the queries against their SQL."""

from __future__ import annotations

import random

import pytest
from fixtures import words
from oracle import connect, differences

import __spark_entry__ as entry_points
import corpus_pipeline
from tideline.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLES[name]) is None


def test_every_operator_is_registered():
    names = set(entry_points.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} >= set(range(1, 11))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean texts, junk, copies, near copies and leaks."""
    base = str(tmp_path_factory.mktemp("corpus"))
    rng = random.Random(8)
    clean = [" ".join(words(rng, 80 if i == 1 else rng.randint(30, 80))) for i in range(80)]
    junk = [" | ".join(words(rng, 40)).upper() + "!!! $$$" for _ in range(40)]
    items = [" ".join(words(rng, 40)) for _ in range(5)]
    near = clean[1].split()
    near[20] = "other"
    planted = [clean[0], " " + clean[0].replace(" ", "\n"), clean[1] + " " + clean[1][:0], " ".join(near), clean[2] + " " + items[0], items[1].upper() + " " + clean[3], None, ""]
    texts = clean + junk + planted
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, int(i < 80), 0) for i in range(120)], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stage(step(spark, docs, folder), name)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    quality, exact, near, leaks = kept
    assert len(quality & set(range(80))) >= 76 and len(quality & set(range(80, 120))) <= 4
    assert quality - exact <= {0, 1, 120, 121, 122, 126, 127} and len(exact & {0, 120, 121}) <= 1
    assert near <= exact and len(near & {1, 122, 123}) <= 1
    assert near - leaks == near & {124, 125}


def test_rows_of_null_and_repeated_ids_are_decided_one_by_one(spark, folder):
    rng = random.Random(3)
    a, b, c, d, e = (" ".join(words(rng, 60)) for _ in range(5))
    near = " ".join(["other", *e.split()[1:]])
    leak = " ".join(words(rng, 20)) + " " + spark.read.parquet(f"{folder}/benchmark.parquet").first()["text"]
    rows = [(None, a), (None, leak), (None, b), (None, " " + b), (None, b), (7, c), (7, leak + " x"), (7, c), (8, d), (None, d), (None, e), (None, near), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "src", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")

    def after(step):
        return sorted(((r["doc_id"], r["text"]) for r in step(spark, docs, folder).collect()), key=str)

    def want(*gone):
        left = list(rows)
        for i in gone:
            left.remove(rows[i])
        return sorted(left, key=str)

    assert after(corpus_pipeline.drop_contaminated) == want(1, 6)
    assert after(corpus_pipeline.drop_copies) == want(2, 4, 7, 9, 13)
    near_left = after(corpus_pipeline.drop_near_copies)
    assert len(near_left) == 8 and {(7, c), (8, d), (9, None), (None, ""), (None, a)} <= set(near_left)
    assert [sum(t is not None and t.strip() in x for _, t in near_left) for x in ([b], [e, near], [leak, leak + " x"])] == [1, 1, 1]


def test_run_and_empty_tables(spark, folder, tmp_path):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 50
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").where("false").write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
