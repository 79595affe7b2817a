"""The topic fit over blocks of documents: Spark's own topics, terms read once, blocks and the sample's repeats."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import functions as F

from ledgerline.operators import topics as T

BUCKETS = 64


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(5)
    letters = [f"term{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    rows = [(i, " ".join(rng.choice(letters[(i % 3) * 12 :][:14], 1 + i * 7 % 60))) for i in range(90)] + [(100, None), (101, ""), (102, "12 of"), (3, "terma")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(3, "doc_id")


def test_topics_are_those_of_spark(docs):
    words = T.terms_of(docs).cache()
    model, placed = T.fit_topics(words, 3, 11, 6, BUCKETS)
    hashed = words.withColumn("b", F.transform("words", lambda w: T.bucket(w, BUCKETS).cast("string")))
    tf = CountVectorizerModel.from_vocabulary([str(i) for i in range(BUCKETS)], inputCol="b", outputCol="tf").transform(hashed)
    spark_own = LDA(k=3, maxIter=6, seed=11, featuresCol="tf", optimizer="online", subsamplingRate=1.0).fit(tf)
    assert model.weights == pytest.approx(spark_own.topicsMatrix().toArray(), rel=1e-8)
    assert model.alpha == pytest.approx(spark_own.estimatedDocConcentration().toArray(), rel=1e-8)
    got, want = ({(r["doc_id"], tuple(np.round(r["topicDistribution"].toArray(), 7))) for r in x.select("doc_id", "topicDistribution").collect()} for x in (placed, spark_own.transform(tf)))
    assert got == want and len(got) == 94
    assert [(r["topic"], r["termIndices"]) for r in model.describeTopics(4).collect()] == [(r["topic"], r["termIndices"]) for r in spark_own.describeTopics(4).collect()]


def test_terms_are_read_once_for_fit_and_places(spark, docs):
    seen = spark.sparkContext.accumulator(0)

    def step(x):
        seen.add(1)
        return x

    words = T.terms_of(docs).withColumn("words", F.udf(step, "array<string>")("words"))
    assert T.fit_topics(words, 2, 1, 3, BUCKETS)[1].filter(F.col("topicDistribution").isNotNull()).count() == 94
    assert seen.value == 94


def test_blocks_make_no_difference(monkeypatch):
    rng = np.random.default_rng(2)
    sizes = [0, 1, 5, 40, 40, 3, 0, 17, 64, 2]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.concatenate([np.sort(rng.choice(BUCKETS, n, replace=False)) for n in sizes]).astype(np.int32)
    counts = rng.integers(1, 9, len(ids)).astype(np.int32)
    shares, alpha, start = T._shares(rng.gamma(2, 1, (BUCKETS, 3))), np.array([0.2, 0.3, 0.4]), rng.gamma(100, 0.01, 3)
    whole = T.infer(ids, counts, ends, shares, alpha, start)[0]
    monkeypatch.setattr(T, "CELLS", 1)  # one document a block
    assert T.infer(ids, counts, ends, shares, alpha, start)[0] == pytest.approx(whole, rel=1e-9)
    assert whole[1:].sum(axis=1)[[0, 1, 2]] == pytest.approx([counts[ends[i] : ends[i + 1]].sum() + alpha.sum() for i in (1, 2, 3)])


def test_empty_input(spark, docs):
    model, placed = T.fit_topics(T.terms_of(docs.filter(F.lit(False))), 2, 1, 2, BUCKETS)
    assert placed.count() == 0 and model.describeTopics(2).count() == 2
