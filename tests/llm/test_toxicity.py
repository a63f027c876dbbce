import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cabtally.llm.toxicity import (
    Classifier,
    LabelModel,
    clean_documents,
    held_out,
    mined_voters,
    op3_toxicity,
    toxicity,
)


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean and toxic texts in which three words no lexicon knows tell the label."""
    rng = np.random.default_rng(3)
    words = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyz'[i // 100]}" for i in range(600)]
    docs, labels = [], []
    for i in range(900):
        text = rng.choice(words, rng.integers(5, 60)).tolist()
        toxic = int(i % 6 == 0)
        if toxic:
            text[1:1] = rng.choice(["zorgle", "blaxed", "quimpy"], rng.integers(1, 3)).tolist()
        docs.append((i, " ".join(text)))
        labels.append((i, 1, toxic))
    folder = tmp_path_factory.mktemp("toxic")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def scored(spark, corpus):
    return {r.doc_id: r for r in op3_toxicity(spark, corpus).collect()}


def test_held_out_rows_are_told_from_clean_ones(scored):
    assert len(scored) == 900
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in scored.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.values())
    held = [(r.score, i % 6 == 0) for i, r in scored.items() if r.held_out]
    toxic, clean = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.99
    assert np.mean([s >= 0.7 for s in toxic]) > 0.95 and np.mean([s >= 0.7 for s in clean]) < 0.01


def test_labels_of_held_out_rows_are_not_used(spark, corpus, scored):
    documents = spark.read.parquet(f"{corpus}/documents.parquet")
    labels = spark.read.parquet(f"{corpus}/labels.parquet")
    lied = labels.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for r in toxicity(documents, lied).collect():
        assert r.score == pytest.approx(scored[r.doc_id].score, abs=1e-12)


def test_nulls_repeats_missing_labels_and_clashing_columns(spark, corpus):
    rows = [(1, None, "a"), (None, "you are an idiot and a moron", "b"), (2, "", "c"), (2, "", "c"), (3, "fine", "d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(None, 1), (1, None), (3, 0), (3, 0)], "doc_id long, toxic int")
    assert len(toxicity(frame, labels).collect()) == 5
    kept = clean_documents(frame, labels)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect() if r.text != rows[1][1]} == {1, 2, 3}


def test_model_finds_accuracies_and_correlations(spark):
    rng = np.random.default_rng(7)
    n, prior = 20_000, 0.2
    y = rng.random(n) < prior
    fire = np.array([np.where(y, rng.random(n) < a, rng.random(n) < b) for a, b in ((0.7, 0.02), (0.5, 0.05), (0.6, 0.01))])
    fire = np.vstack([fire, fire[0]])  # a voter that repeats the first
    hits = [[int(j) for j in np.flatnonzero(f)] for f in fire.T]
    patterns = spark.createDataFrame([(h,) for h in hits], "hits array<int>").groupBy("hits").agg(F.count("*").alias("n"))
    silent = [np.mean([not h for h, t in zip(hits, y, strict=True) if t == k]) for k in (True, False)]
    model = LabelModel(prior, tuple(silent), np.full(4, 0.4), np.full(4, 0.05)).fit(patterns, 15)
    assert (0, 3) in model.correlations and model.correlations[0, 3] > 0.8
    assert np.allclose(model.share[[0, 3]], 0.5, atol=0.1)
    assert np.allclose(model.toxic[:3], [0.7, 0.5, 0.6], atol=0.12)


def test_classifier_weights_what_tells_the_labels():
    rng = np.random.default_rng(2)
    rows = [sorted(set(rng.integers(10, 500, 30).tolist()) | ({1} if i % 4 == 0 else set())) for i in range(800)]
    p = np.array([0.95 if i % 4 == 0 else 0.02 for i in range(800)])
    offsets = np.cumsum([0, *map(len, rows)])
    model = Classifier.fit(np.concatenate(rows), offsets, p)
    assert model.weights[1] > 3 and max([0, *(w for f, w in model.weights.items() if f != 1)]) < 1
    assert Classifier.fit(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0)).weights == {}


def test_every_feature_with_evidence_is_a_voter_once_per_family(spark):
    letters = "abcdefghijklmnopqrst"
    rare = [f"{a}{b}zz" for a in letters for b in letters]  # 400 words, each in 6 of 400 toxic documents
    rows = [(" ".join(rare[(i + k) % 400] for k in range(6)), 1) for i in range(400)]
    rows += [(f"fine{letters[i % 20]} text", 0) for i in range(4000)]
    assert set(mined_voters(spark.createDataFrame(rows, "text string, toxic int"), 400, 4000)) == set(rare)
    rows = [("quorvelnight", 1)] * 4 + [(f"fine{letters[i % 20]} text", 0) for i in range(400)]
    assert mined_voters(spark.createDataFrame(rows, "text string, toxic int"), 4, 400) == ["quor-"]


def test_classifier_learns_from_every_document(spark):
    # Exclamation marks are a voter but no feature, so the score is the share of toxic texts.
    texts = [(i, "alpha beta gamma" + " !!!" * (i % 100 == 0)) for i in range(15_000)]
    documents = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(0, 15_000, 10)], "doc_id long, toxic int")
    scores = [r.score for r in toxicity(documents, labels).collect()]
    assert len(scores) == 15_000
    assert min(scores) == max(scores) == pytest.approx(0.01, abs=0.003)
