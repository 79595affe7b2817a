"""Quality (operator 1): a regularised quadratic discriminant over transformed document statistics.

Each text gives ``len(FEATURES)`` statistics of its whole length (lengths, shares of kinds of characters, repeated
words, lines and passages), transformed by logarithms so that ordinary text is near to normal. Means and
covariances of both classes come from sums over all labelled training rows, taken by Spark. A class'
covariance is shrunk towards the pooled one, and that towards its diagonal. The score of a text is the
posterior of class 1 from the difference of the two log densities; each density uses the Cholesky
factor of its covariance, computed once.

Rows: null and empty texts have all statistics of an empty text and are scored by them; repeated rows and
null ids each give their row. Ids with contradicting labels do not train. Without rows of both
classes the score is the share of class 1, or 0.5. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import crc_mod, mapped, shingle_hashes, stored, text_bytes, text_steps, word_hashes

FEATURES = ("length", "word_length", "upper", "digit", "mark", "symbol", "foreign", "distinct", "twin", "repeated", "lines", "same_byte")
#: Weight of the pooled covariance in a class' own, and of the diagonal in the pooled one.
POOLED, DIAGONAL = 0.2, 0.05
THRESHOLD = 0.7

# Kinds of bytes: 1 upper case, 2 digit, 3 marks of running text, 4 other signs, 5 part of a non-ASCII character.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[33:127] = 4
_KIND[97:123] = 0
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_KIND[128:] = 5


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of statistics for each text (large_string, no nulls)."""
    data, bounds = text_bytes(texts)
    size = np.maximum(np.diff(bounds), 1)

    def share(flags: np.ndarray) -> np.ndarray:
        upto = np.concatenate([[0], np.cumsum(flags)])
        return (upto[bounds[1:]] - upto[bounds[:-1]]) / size

    kind = _KIND[data]
    same = np.zeros(len(data), dtype=bool)
    same[1:] = data[1:] == data[:-1]
    words, at = word_hashes(texts)
    n = np.diff(at)
    some = np.maximum(n, 1)
    twin = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words):
        twin[2:] = np.cumsum(words[1:] == words[:-1])
    distinct, passages = np.ones(len(n)), np.ones(len(n))
    for i, (s, e) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if e > s:
            distinct[i] = len(np.unique(words[s:e])) / (e - s)
            passages[i] = len(shingle_hashes(words[s:e])) / max(1, e - s - 4)
    log = np.log
    return np.column_stack(
        [
            np.log1p(n),
            np.log1p(size / some),
            *(log(share(kind == k) + 0.002) for k in (1, 2, 3, 4, 5)),
            log(distinct) + 0.08 * np.log1p(n),
            log(np.maximum(twin[at[1:]] - twin[np.minimum(at[:-1] + 1, at[1:])], 0) / some + 0.002),
            log(1.002 - np.minimum(passages, 1)),
            log(share(data == 10) + 0.002),
            log(share(same) + 0.002),
        ]
    )


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_steps(batch):
            x = statistics(texts)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), *(pa.array(c) for c in x.T)], names=["doc_id", "held_out", *FEATURES])


class Discriminant:
    """Two normal densities with shrunk covariances and their Cholesky factors."""

    def __init__(self, counts: list[float], sums: list[np.ndarray], products: list[np.ndarray], pooled: float = POOLED, diagonal: float = DIAGONAL):
        self.known = min(counts) >= 2
        total = sum(counts)
        self.share = (counts[1] / total) if total else 0.5
        if not self.known:
            return
        self.means = [s / n for s, n in zip(sums, counts)]
        own = [p / n - np.outer(m, m) for p, n, m in zip(products, counts, self.means)]
        common = sum(n * c for n, c in zip(counts, own)) / total
        common = (1 - diagonal) * common + diagonal * np.diag(np.diag(common)) + 1e-6 * np.eye(len(common))
        self.factors = [np.linalg.cholesky((1 - pooled) * c + pooled * common) for c in own]
        self.inverses = [np.linalg.inv(f) for f in self.factors]
        self.logs = [2 * np.log(np.diag(f)).sum() for f in self.factors]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.known:
            return np.full(len(x), self.share)
        log = [-0.5 * ((((x - m) @ inv.T) ** 2).sum(axis=1) + d) for m, inv, d in zip(self.means, self.inverses, self.logs)]
        odds = log[1] - log[0] + np.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _fit(described: DataFrame, labels: DataFrame, label: str) -> Discriminant:
    clear = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z").select("doc_id", "y")
    train = described.where(~F.col("held_out")).join(clear, "doc_id")
    pairs = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]
    sums = [F.count("*").cast("double")] + [F.sum(f) for f in FEATURES] + [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])) for i, j in pairs]
    rows = {r[0]: np.array(r[1:], dtype=float) for r in train.groupBy("y").agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).collect()}  # two rows
    p = len(FEATURES)
    empty = np.zeros(1 + p + len(pairs))
    counts, means, products = [], [], []
    for y in (0, 1):
        r = rows.get(y, empty)
        m = np.zeros((p, p))
        for (i, j), v in zip(pairs, r[1 + p :]):
            m[i, j] = m[j, i] = v
        counts.append(float(r[0])), means.append(r[1 : 1 + p]), products.append(m)
    return Discriminant(counts, means, products)


def scored(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row; rows of ``labels(doc_id, label)`` that are not held out train."""
    return _scored(_described(docs, held_out), labels, label).select("doc_id", "held_out", "score", "predicted")


def _described(docs: DataFrame, held_out: Column) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", held_out.alias("held_out"), "text")
    return stored(mapped(source, _describe, f"doc_id {kind}, held_out boolean, " + ", ".join(f"{f} double" for f in FEATURES)), "described")


def _scored(described: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    model = _fit(described, labels, label)
    kind = described.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack([batch.column(f).to_numpy(zero_copy_only=False) for f in FEATURES])
            s = model.score(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return mapped(described, step, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more. Statistics are computed beside the row, so no join is needed."""
    model = _fit(_described(docs, held_out), labels, "quality")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_steps(batch):
                yield part.filter(pa.array(model.score(statistics(texts)) >= THRESHOLD))

    return mapped(docs, step, docs.schema)


def op1_qda_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), crc_mod("doc_id", 4) == 2)
