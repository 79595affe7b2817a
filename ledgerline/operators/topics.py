"""Topics over a hashed term space.

Terms become one of ``BUCKETS`` numbers by their hash, so the model, its vocabulary and the
driver hold ``topics x BUCKETS`` numbers however many different terms the documents have.
The terms behind the buckets that matter are found afterwards by a join: a bucket is
reported as its most frequent term, with the number of terms that share it, so a collision
is visible in the result.

The fit is online variational Bayes with Spark's settings, samples, starts and stopping rule
(``LDA(optimizer="online", subsamplingRate=1.0)``), so it finds Spark's topics but for rounding.
Nearly all its time is a fixed point per document, hundreds of steps of a few microseconds; here
a task takes them for many documents of like size at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ledgerline.session import cut_lineage, in_arrow

BUCKETS = 1 << 17
SLICE = 1 << 10  # buckets whose sums travel as one row
CELLS = 3 << 14  # terms of the documents that are taken at a time: their weights fit a core's cache
LEARNING_OFFSET, LEARNING_DECAY, GAMMA_SHAPE, CLOSE = 1024.0, 0.51, 100.0, 1e-3  # Spark's defaults


def bucket(term: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def terms_of(docs: DataFrame, min_token: int = 3) -> DataFrame:
    """``docs`` with ``words``: lower-cased runs of letters of ``min_token`` or more, stop words left out."""
    tok = RegexTokenizer(inputCol="text", outputCol="tokens", pattern=r"[^\p{L}]+", minTokenLength=min_token)
    known = docs.withColumn("text", F.coalesce("text", F.lit("")))
    return StopWordsRemover(inputCol="tokens", outputCol="words").transform(tok.transform(known)).drop("tokens")


def fit_topics(words: DataFrame, k: int, seed: int, max_iter: int = 10, buckets: int = BUCKETS) -> tuple[Topics, DataFrame]:
    """The model, and the columns of ``words`` but its texts with ``topicDistribution``.

    The terms are counted once and checkpointed, in the partitions of ``words``: samples and starts go by them.
    """
    spark = words.sparkSession
    hashed = words.withColumn("_terms", F.transform("words", lambda w: bucket(w, buckets))).drop("text", "words")
    kept = hashed.drop("_terms")
    pairs = [StructField("_ids", ArrayType(IntegerType())), StructField("_counts", ArrayType(IntegerType()))]
    tf = in_arrow(hashed, _counter(buckets), StructType([*kept.schema.fields, *pairs]))
    tf = cut_lineage(tf.withColumn("_row", F.monotonically_increasing_id()))
    (weights, place_seed), alpha, n_docs, updates = _first_weights(spark, k, seed, buckets), np.full(k, 1.0 / k), tf.count(), 0
    parts = tf.rdd.getNumPartitions()
    seeds = spark._jvm.java.util.Random(seed)
    seeds.nextLong()  # the one of the first weights
    ahead = None
    for _ in range(max_iter if n_docs else 0):
        sample, ahead = seeds.nextLong() if ahead is None else ahead, None
        inference = seeds.nextLong()
        starts = [_start(spark, inference + part, k) for part in range(parts)]
        sums, log_theta, n_read, n_used = _sums(tf.sample(True, 1.0, sample).select("_row", "_ids", "_counts"), weights, alpha, starts)
        if not n_read:
            ahead = inference  # an empty sample takes one seed only
            continue
        updates += 1
        if n_used:
            rate = (LEARNING_OFFSET + updates) ** -LEARNING_DECAY
            weights = (1 - rate) * weights + rate * (sums + 1.0 / k)
            alpha = _next_alpha(alpha, log_theta / n_used, n_used, rate)
    model = Topics(spark, weights, alpha)
    placed = in_arrow(tf.drop("_row"), _placer(spark.sparkContext.broadcast(_shares(weights)), alpha, _start(spark, place_seed, k)),
                      StructType([*kept.schema.fields, StructField("_topics", ArrayType(DoubleType()))]))
    return model, placed.select(*kept.columns, array_to_vector("_topics").alias("topicDistribution"))


class Topics:
    """Fitted topics: ``weights`` (buckets x topics) and the documents' prior ``alpha``."""

    def __init__(self, spark: SparkSession, weights: np.ndarray, alpha: np.ndarray):
        self.spark, self.weights, self.alpha = spark, weights, alpha

    def describeTopics(self, most: int = 10) -> DataFrame:
        """``topic, termIndices, termWeights``: the ``most`` heaviest buckets of each topic (as Spark's own models)."""
        shares = self.weights / self.weights.sum(axis=0)
        best = [np.argsort(-w, kind="stable")[:most] for w in shares.T]
        rows = [(i, b.tolist(), shares[b, i].tolist()) for i, b in enumerate(best)]
        return self.spark.createDataFrame(rows, "topic int, termIndices array<int>, termWeights array<double>")


def _first_weights(spark: SparkSession, k: int, seed: int, buckets: int) -> tuple[np.ndarray, int]:
    """The weights that Spark's fit starts from, those of a model without iterations, and the seed by which its models place documents."""
    one = spark.createDataFrame([(Vectors.sparse(buckets, {}),)], ["tf"])
    model = LDA(k=k, maxIter=0, seed=seed, featuresCol="tf", optimizer="online").fit(one)
    return model.topicsMatrix().toArray(), model._java_obj.oldLocalModel().getSeed()


def _start(spark: SparkSession, seed: int, k: int) -> np.ndarray:
    """Where the topics of each document of a partition start: ``k`` gamma draws, by the generator that Spark's fit has."""
    halves = spark.sparkContext._gateway.new_array(spark._jvm.int, 2)
    for i, half in enumerate((seed >> 32, seed)):
        halves[i] = (half + (1 << 31)) % (1 << 32) - (1 << 31)
    random = spark._jvm.breeze.stats.distributions
    draws = random.Gamma(GAMMA_SHAPE, 1.0 / GAMMA_SHAPE, random.RandBasis(spark._jvm.org.apache.commons.math3.random.MersenneTwister(halves)))
    return np.array([draws.draw() for _ in range(k)])


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and where each row's begin and the last's end."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _counter(buckets: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, ends = _lists(batch.column("_terms"))
            doc = np.repeat(np.arange(batch.num_rows, dtype=np.int64), np.diff(ends))
            found, n = np.unique(doc * buckets + terms, return_counts=True)
            at = pa.array(np.searchsorted(found, np.arange(batch.num_rows + 1) * buckets), pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (found % buckets, n)]
            rest = [name for name in batch.schema.names if name != "_terms"]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), *lists], names=[*rest, "_ids", "_counts"])

    return step


def _placer(shares, alpha: np.ndarray, start: np.ndarray):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (ids, ends), counts = _lists(batch.column("_ids")), _lists(batch.column("_counts"))[0]
            gamma = infer(ids, counts, ends, shares.value, alpha, start)[0]
            share = np.where(np.diff(ends)[:, None] > 0, gamma / gamma.sum(axis=1, keepdims=True), 0.0)  # none without terms
            at = pa.array(np.arange(len(share) + 1) * len(alpha), pa.int32())
            rest = [name for name in batch.schema.names if name not in ("_ids", "_counts")]
            topics = pa.ListArray.from_arrays(at, pa.array(share.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in rest), topics], names=[*rest, "_topics"])

    return step


def _sums(tf: DataFrame, weights: np.ndarray, alpha: np.ndarray, starts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Expected counts per bucket and topic, the documents' summed ``E[log theta]``, documents read, and those with terms.

    A sample has some documents several times, one after the other: they start alike, so one of them is inferred and counts for all.
    """
    k, buckets = len(alpha), len(weights)
    shares = tf.sparkSession.sparkContext.broadcast(_shares(weights))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, own = starts[TaskContext.get().partitionId()], shares.value
        sums, rest = np.zeros((buckets, k)), np.zeros(k + 2)
        for batch in batches:
            row = batch.column("_row").to_numpy()
            first = np.flatnonzero(np.diff(row, prepend=-1))
            times = np.diff(first, append=len(row))
            batch = batch.take(pa.array(first))
            (ids, ends), counts = _lists(batch.column("_ids")), _lists(batch.column("_counts"))[0]
            gamma, theta = infer(ids, counts, ends, own, alpha, start)
            used = np.where(np.diff(ends) > 0, times, 0)
            rest += [*(used @ _log_expectation(gamma)), len(row), used.sum()]
            _add_counts(sums, ids, counts * np.repeat(times, np.diff(ends)), ends, own, theta)
        if rest[k]:
            parts = [(-1, rest), *((i, part) for i in range(0, buckets, SLICE) if (part := sums[i : i + SLICE]).any())]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int32()), pa.array([x.tobytes() for _, x in parts], pa.binary())], names=["slice", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer()) for x in table.column("sums"))
        return pa.table({"slice": table.column("slice")[:1], "sums": pa.array([total.tobytes()], pa.binary())})

    kind = "slice int, sums binary"
    found = {r["slice"]: np.frombuffer(r["sums"]) for r in in_arrow(tf, step, kind).groupBy("slice").applyInArrow(add, kind).collect()}
    shares.destroy()
    rest = found.pop(-1, np.zeros(k + 2))
    total = np.zeros((buckets, k))
    for i, part in found.items():
        total[i : i + SLICE] = part.reshape(-1, k)
    return total * _shares(weights), rest[:k], int(rest[k]), int(rest[k + 1])


def _add_counts(sums: np.ndarray, ids: np.ndarray, counts: np.ndarray, ends: np.ndarray, shares: np.ndarray, theta: np.ndarray) -> None:
    """Add each term's count, divided over the topics and by its share there, to ``sums``."""
    sizes, most = np.diff(ends), 4 * CELLS
    cuts = np.unique(np.searchsorted(ends, np.arange(0, ends[-1] + most, most)).clip(0, len(sizes)))
    for first, last in zip(cuts[:-1], cuts[1:]):
        part = slice(ends[first], ends[last])
        if part.start == part.stop:
            continue
        own = np.repeat(theta[first:last], sizes[first:last], axis=0)
        each = counts[part] / (np.einsum("nk,nk->n", shares[ids[part]], own) + 1e-100)
        for topic in range(theta.shape[1]):
            sums[:, topic] += np.bincount(ids[part], each * own[:, topic], len(sums))


def infer(ids: np.ndarray, counts: np.ndarray, ends: np.ndarray, shares: np.ndarray, alpha: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``gamma`` and ``exp(E[log theta])`` of each document: steps from ``start`` until the mean change is at most ``CLOSE``.

    Documents are taken in blocks of like size. When a block has lost half of them, the others wait to meet in new blocks.
    """
    sizes = np.diff(ends)
    gamma = np.tile(start, (len(sizes), 1))
    theta = np.exp(_log_expectation(gamma))
    left = np.argsort(sizes, kind="stable")
    left = left[sizes[left] > 0]
    while len(left):
        still, at = [], 0
        while at < len(left):
            last = at + max(1, int(np.searchsorted(sizes[left[at:]] * np.arange(1, len(left) - at + 1), CELLS, "right")))
            still.append(_advance(left[at:last], ids, counts, ends, shares, alpha, gamma, theta))
            at = last
        left = np.concatenate(still)
    return gamma, theta


def _advance(docs, ids, counts, ends, shares, alpha, gamma, theta) -> np.ndarray:
    """Take a block's documents further, in ``gamma`` and ``theta``, until half have settled; return the others."""
    sizes = ends[docs + 1] - ends[docs]
    place = np.arange(sizes.max())
    real = place < sizes[:, None]
    at = np.where(real, ends[docs][:, None] + place, 0)
    n = np.where(real, counts[at], 0).astype(float)
    share = shares[ids[at]].transpose(0, 2, 1)
    share = np.ascontiguousarray(share[:, 1:] / share[:, :1])  # documents x topics but the first x terms, against the first topic's
    total = _digamma(n.sum(axis=1, keepdims=True) + alpha.sum())  # the sum of a document's gamma stays
    g, t, moving = gamma[docs], theta[docs], np.ones(len(docs), bool)
    least = len(docs) // 2
    while (open_ := np.count_nonzero(moving)) > least:
        if 8 * open_ < 7 * len(docs):
            docs, n, share, total, g, t = (x[moving] for x in (docs, n, share, total, g, t))
            moving = np.ones(len(docs), bool)
        norm = np.matmul(t[:, None, 1:], share)[:, 0]
        norm += t[:, :1]
        np.divide(n, norm, out=norm)
        new = np.empty_like(g)
        new[:, 0] = norm.sum(axis=1)
        new[:, 1:] = np.matmul(share, norm[:, :, None])[:, :, 0]
        new *= t
        new += alpha
        t = np.exp(_digamma(new) - total)
        moved = np.abs(new - g).sum(axis=1) > CLOSE * len(alpha)
        g = new
        if not moved.all():
            settled = moving & ~moved
            gamma[docs[settled]], theta[docs[settled]] = g[settled], t[settled]
            moving &= moved
    gamma[docs[moving]], theta[docs[moving]] = g[moving], t[moving]
    return docs[moving]


def _shares(weights: np.ndarray) -> np.ndarray:
    return np.exp(_log_expectation(weights.T).T)


def _log_expectation(x: np.ndarray) -> np.ndarray:
    """``E[log p]`` of Dirichlet distributions, one a row."""
    return _digamma(x) - _digamma(x.sum(axis=-1, keepdims=True))


def _digamma(x: np.ndarray) -> np.ndarray:
    """The logarithmic derivative of the gamma function for x > 0, by its series at x + 6.

    The last term is the error of the one in Spark's fit (its series begins at 49 or above and has a sign wrong): 3e-9 at
    most, but documents between two topics go one way or the other by such differences.
    """
    y, z = x * (x + 5.0), x + 6.0
    f = 1.0 / (z * z)
    series = f * (-1 / 12 + f * (1 / 120 + f * (-1 / 252 + f * (1 / 240 + f * (-1 / 132 + f * (691 / 32760 - f / 12))))))
    psi = np.log(z) - 0.5 / z + series - (2.0 * x + 5.0) * (1.0 / y + 1.0 / (y + 4.0) + 1.0 / (y + 6.0))
    f = x + np.ceil(np.maximum(49.0 - x, 0.0))
    f *= f
    return psi - 1.0 / (60.0 * f * f)


def _trigamma(x: np.ndarray) -> np.ndarray:
    z = x + 6.0
    f = 1.0 / (z * z)
    series = f / 2 + (1.0 + f * (1 / 6 + f * (-1 / 30 + f * (1 / 42 + f * (-1 / 30 + f * (5 / 66 + f * (-691 / 2730 + f * 7 / 6))))))) / z
    return series + sum(1.0 / (x + i) ** 2 for i in range(6))


def _next_alpha(alpha: np.ndarray, log_theta: np.ndarray, n: int, rate: float) -> np.ndarray:
    """A Newton step of the documents' prior, weighted by ``rate`` and left out if it leaves the positive numbers."""
    gradient = n * (log_theta - _log_expectation(alpha))
    c, q = n * _trigamma(alpha.sum()), -n * _trigamma(alpha)
    b = (gradient / q).sum() / (1 / c + (1 / q).sum())
    moved = alpha - rate * (gradient - b) / q
    return moved if (moved > 0).all() else alpha


def topic_terms(lda, words: DataFrame, most: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """``topic, rank, term, weight, n_terms``: the heaviest buckets of each topic, each as its most frequent term
    (ties: the smaller), with the number of terms in the bucket."""
    top = lda.describeTopics(most).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "t"))
    top = top.select("topic", (F.col("rank") + 1).alias("rank"), F.col("t.termIndices").alias("bucket"), F.col("t.termWeights").alias("weight"))
    asked = [r["bucket"] for r in top.select("bucket").distinct().collect()]  # k x most buckets at most
    terms = words.select(F.explode("words").alias("term")).withColumn("bucket", bucket(F.col("term"), buckets))
    wanted = terms.filter(F.col("bucket").isin(asked)).groupBy("bucket", "term").agg(F.count(F.lit(1)).alias("n"))
    best = wanted.groupBy("bucket").agg(F.min(F.struct((-F.col("n")).alias("less"), "term")).alias("b"), F.count(F.lit(1)).alias("n_terms"))
    return top.join(best, "bucket", "left").select("topic", "rank", F.col("b.term").alias("term"), "weight", F.coalesce("n_terms", F.lit(0)).alias("n_terms"))


def class_terms(words: DataFrame, cls: str, most: int = 10, slices: int = 64) -> DataFrame:
    """Class-based TF-IDF (T11): ``tf(t, c) / words(c) * log(1 + mean words per class / total frequency of t)``, the
    ``most`` best terms of each class. The best of ``slices`` hashed parts of a class are ranked first, so no task
    ranks all terms of a class."""
    tf = words.select(cls, F.explode("tokens").alias("term")).groupBy(cls, "term").agg(F.count(F.lit(1)).alias("tf"))
    per_c = tf.groupBy(cls).agg(F.sum("tf").alias("wc"))
    per_t = tf.groupBy("term").agg(F.sum("tf").alias("ft"))
    mean = per_c.agg(F.avg("wc").alias("aw")).withColumn("_one", F.lit(1))
    j = tf.join(per_c, cls).join(per_t, "term").withColumn("_one", F.lit(1)).join(F.broadcast(mean), "_one")
    j = j.withColumn("ctfidf", F.col("tf") / F.col("wc") * F.log(1 + F.col("aw") / F.col("ft"))).withColumn("_s", F.pmod(F.xxhash64("term"), F.lit(slices)))
    best = [F.col("ctfidf").desc(), "term"]
    j = j.withColumn("_r", F.row_number().over(W.partitionBy(cls, "_s").orderBy(*best))).filter(F.col("_r") <= most)
    return j.withColumn("rank", F.row_number().over(W.partitionBy(cls).orderBy(*best))).filter(F.col("rank") <= most).select(cls, "rank", "term", "ctfidf")
