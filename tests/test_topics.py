"""Topics over hashed terms against topics over a vocabulary, collisions, class terms."""

import numpy as np
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from ledgerline.operators import topics as T


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(3)
    kinds = [["apple", "pear", "plum", "cherry"], ["bolt", "screw", "wrench", "hammer"]]
    rows = [(i, " ".join(rng.choice(kinds[i % 2], 30, p=[0.4, 0.3, 0.2, 0.1]))) for i in range(60)] + [(90, None), (91, ""), (92, "The and 12 of")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_top_terms_equal_the_direct_way(docs):
    words = T.terms_of(docs)
    lda, placed = T.fit_topics(words, 2, 1, max_iter=20, buckets=1 << 12)
    got = {}
    for r in T.topic_terms(lda, words, 4, 1 << 12).collect():
        got.setdefault(r.topic, []).append((r["rank"], r.term, r.n_terms))
    hashed = {frozenset(t for _, t, _ in terms) for terms in got.values()}
    cv = CountVectorizer(inputCol="words", outputCol="tf").fit(words)
    tf = cv.transform(words)
    direct = LDA(k=2, maxIter=20, seed=1, featuresCol="tf", optimizer="online", subsamplingRate=1.0).fit(tf)
    want = {frozenset(cv.vocabulary[i] for i in r.termIndices) for r in direct.describeTopics(4).collect()}
    assert hashed == want == {frozenset(["apple", "pear", "plum", "cherry"]), frozenset(["bolt", "screw", "wrench", "hammer"])}
    assert all(n == 1 for terms in got.values() for *_, n in terms) and placed.count() == 63


def test_collisions_are_visible(docs):
    words = T.terms_of(docs)
    lda, _ = T.fit_topics(words, 2, 1, max_iter=2, buckets=2)  # eight terms in two buckets
    rows = T.topic_terms(lda, words, 2, 2).collect()
    assert {r.n_terms for r in rows} <= set(range(1, 9)) and sum({r.term: r.n_terms for r in rows}.values()) == 8


def test_class_terms_by_hand(spark):
    df = spark.createDataFrame([(0, ["a", "a", "b"]), (1, ["b", "c"]), (1, ["c"])], "cls int, tokens array<string>")
    got = {(r.cls, r["rank"]): (r.term, r.ctfidf) for r in T.class_terms(df, "cls", most=1, slices=2).collect()}
    mean = 3.0  # three words in each class
    assert got[(0, 1)] == ("a", pytest.approx(2 / 3 * np.log(1 + mean / 2)))
    assert got[(1, 1)] == ("c", pytest.approx(2 / 3 * np.log(1 + mean / 2)))
    assert T.class_terms(df.filter(F.lit(False)), "cls").count() == 0
