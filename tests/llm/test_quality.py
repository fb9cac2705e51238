"""Held-out accuracy of the quality classifier; its parts; awkward tables."""

from __future__ import annotations

import numpy as np
import pytest
from fixtures import awkward, documents
from pyspark.sql import functions as F

from tideline.llm import quality
from tideline.llm.quality import fit, lowest_labels, pooled, rows_of, score_quality, shape, training_labels, word_vectors

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    known = training_labels(labels)
    scores = score_quality(docs, known)
    held = scores.join(labels, scores.id == labels.doc_id).join(known.select("id"), "id", "left_anti").select("score", "quality").toPandas()
    assert len(held) > 80
    assert ((held["score"] >= 0.5) == (held["quality"] == 1)).mean() > 0.93
    assert scores.count() == docs.count() and scores.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_word_vectors_sum_their_neighbours(spark):
    texts = ["alpha beta gamma", "beta gamma", "", "delta"]
    got = word_vectors(documents(spark, list(enumerate(texts))).select("text"))
    place, sign = quality.index_vectors()
    want = np.zeros((quality.ENTRIES, quality.WIDTH))
    for t in texts:
        seq = rows_of(t)
        for i, a in enumerate(seq):
            for j, b in enumerate(seq):
                if i != j and abs(i - j) <= quality.REACH:
                    for m in range(quality.MARKS):
                        want[a, place[m][b]] += sign[m][b]
    for a in set(np.concatenate([rows_of(t) for t in texts])):
        x, y = got[a], want[a]
        assert np.linalg.norm(x) * np.linalg.norm(y) == pytest.approx(float(x @ y), abs=1e-5)


def test_network_is_calibrated():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 6))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    p = fit(x[:3000], y[:3000]).score(x[3000:])
    for low in np.arange(0, 1, 0.25):
        at = (p >= low) & (p < low + 0.25)
        assert abs(p[at].mean() - y[3000:][at].mean()) < 0.1
    assert fit(x[:0], y[:0]).score(x[:2]) == pytest.approx([0.5, 0.5])
    assert (fit(x[:50], np.ones(50)).score(x[:5]) > 0.9).all()


def test_shapes_and_empty_texts():
    assert shape("WORD!!!") == "A!!" and shape("Word") == "a" and shape("x12$$$") == "a0$$"
    assert not pooled("", np.zeros((quality.ENTRIES, quality.WIDTH), np.float32)).any()


def test_awkward(spark):
    rows = awkward()
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)] + [(3, None), (None, 1), (999, 1), (4, 0), (4, 0)], "id long, label int")
    got = score_quality(documents(spark, rows), labels)
    assert got.columns == ["id", "score"]
    found = got.collect()
    assert sorted(str(r["id"]) for r in found) == sorted(str(i) for i, _ in rows)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert score_quality(documents(spark, []), labels).collect() == []
    none = score_quality(documents(spark, rows), labels.where("false")).select(F.min("score"), F.max("score")).first()
    assert none[0] == none[1] == pytest.approx(0.5)


def test_lowest_labels_are_those_of_lowest_hashes(spark):
    rows = [(k % 700, k % 2) for k in range(2000)] + [(5, 1)] * 3000 + [(None, 1), (7, None)]
    labels = spark.createDataFrame(rows, "id long, label int").repartition(5)
    known = labels.dropna().distinct().select(F.xxhash64("id").alias("h"), "id", "label")
    order = [tuple(r)[1:] for r in sorted(map(tuple, known.collect()))]
    for n in (1, 50, len(order), len(order) + 1):
        assert sorted(map(tuple, lowest_labels(labels, n).collect())) == sorted(order[:n])
    assert lowest_labels(labels.limit(0), 5).collect() == []


def test_one_labelled_id_on_most_rows(spark):
    docs = documents(spark, [(1, f"text number {k % 3}") for k in range(300)] + [(2, "another one")])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "id long, label int")
    once = documents(spark, [(1, "text number 0"), (2, "another one")])
    learnt = score_quality(docs, labels, labelled=10).where("id = 2").first()
    assert learnt.score == score_quality(once, labels, labelled=10).where("id = 2").first().score
