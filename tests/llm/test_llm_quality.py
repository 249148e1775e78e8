"""The quality classifier: optimality of the dual solution, held-out accuracy, defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklens.llm import quality
from clicklens.llm.queries import op11_quality
from llm_tools import frame

SF = "/root/testdata/sf0.01"


def test_coordinate_descent_closes_the_duality_gap():
    rng = np.random.default_rng(5)
    n, features = 60, 12
    x = rng.normal(size=(n, features)) * (rng.random((n, features)) < 0.4)
    sign = np.where(x @ rng.normal(size=features) + 0.3 * rng.normal(size=n) > 0, 1.0, -1.0)
    rows = [np.flatnonzero(r) for r in x]
    start = np.cumsum([0, *map(len, rows)])
    index = np.concatenate(rows)
    value = np.concatenate([x[i, r] for i, r in enumerate(rows)])
    cost = np.where(sign > 0, 0.7, 1.3)
    w, alpha = quality.coordinate_descent(start, index, value, sign, cost, features, passes=2000, tolerance=1e-9)
    assert (alpha >= 0).all() and (alpha <= cost).all()
    assert np.allclose(w, (alpha * sign) @ x)
    primal = w @ w / 2 + (cost * np.maximum(0, 1 - sign * (x @ w))).sum()
    dual = alpha.sum() - w @ w / 2
    # A row without a feature keeps its dual variable at 0 and costs the same for any weights.
    dual += cost[[len(r) == 0 for r in rows]].sum()
    assert abs(primal - dual) < 1e-5 * max(1, primal)


def test_grams_are_tokens_pairs_and_echoes():
    assert quality.grams("The cat, the CAT") == {
        "the", "cat", ",", "the cat", "cat ,", ", the", " echo 000", " echo 003", " echo 033"}
    assert " echo 111" in quality.grams("no no no no") and quality.grams(None) == quality.grams(" \n") == set()


def test_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op11_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    assert len(known) > 80
    assert sum(r.predicted == labels[r.doc_id] for r in known) >= 0.98 * len(known)


@pytest.fixture(scope="module")
def model(spark):
    good = [(i, f"a quiet sentence number {i % 7} of plain words", 1) for i in range(40)]
    bad = [(100 + i, f"BUY!!! now {i % 5} $$$ free $$$", 0) for i in range(40)]
    docs = frame(spark, "doc_id long, text string", [r[:2] for r in good + bad] + [(None, "x"), (7, None)])
    labels = frame(spark, "doc_id long, quality int", [(r[0], r[2]) for r in good + bad] + [(None, 1), (500, 1), (1, None)])
    return quality.learn(docs, labels)


def test_cases(spark, model):
    df = frame(spark, "doc_id long, text string, score string, gram int", [
        (1, None, "a", 1), (1, "", "a", 1), (2, "plain words of a quiet sentence", "b", 2), (2, "$$$ BUY!!! $$$", "c", 3),
        (2, "$$$ BUY!!! $$$", "c", 3), (None, "plain words " * 50_000, "d", 4)])
    out = quality.scores(df, model)
    assert out.columns == ["doc_id", "gram", "score"]
    got = sorted((r.gram, r.score) for r in out.collect())
    assert got[0][1] == got[1][1] and got[2][1] > 0.5 > got[3][1] == got[4][1] and got[5][1] > 0.5
    assert quality.scores(df.limit(0), model).count() == 0


def test_without_both_labels_every_score_is_half(spark):
    docs = frame(spark, "doc_id long, text string", [(1, "a"), (2, "b")])
    for rows in ([], [(1, 1), (2, 1)]):
        m = quality.learn(docs, frame(spark, "doc_id long, quality int", rows))
        assert {r.score for r in quality.scores(docs, m).collect()} == {0.5}


def test_the_sample_is_bounded(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20).alias("text"))
    labels = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    sample = quality._sample(docs, labels, "doc_id", "text", "quality", 30, 1000)
    assert {(r.label, r["count"]) for r in sample.groupBy("label").count().collect()} == {(0, 10), (1, 10)}
