"""Trees of a forest that tasks grow on their own (M8).

Spark's forest shuffles the histograms of every node, which for deep trees are far more bytes than the rows.
While the rows, a byte per feature, fit in a task, each task takes all of them and some of the trees:

* features are cut at exact quantiles into ``BINS`` ranges, as many as Spark's forest has by default;
* a row is in a tree's sample as often as a Poisson draw of mean one from the row's hash and the tree's number says;
* per level the classes' counts of all nodes come from sorted rows, ``CHUNK`` nodes at a time; each node draws its
  features, and the split with the largest fall of the Gini impurity is taken, as in Spark's forest;
* the task adds up its trees' class shares for the rows to score; nodes never leave it.

The trees depend on the seed, their numbers and the rows alone, not on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.boosting import bin_borders, bin_rows, partitions_for, uniform
from ledgerline.session import cut_lineage, in_arrow

BINS, CHUNK = 32, 2048
_POISSON = np.cumsum([exp(-1) / factorial(i) for i in range(18)])


@dataclass
class GrownTree:
    """Nodes, children after parents; a leaf has feature -1. ``shares`` are the classes' shares of a node's rows."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    shares: np.ndarray
    depth: int

    def votes(self, bins: np.ndarray) -> np.ndarray:
        """The shares (classes x rows) at the leaves of ``bins`` (features x rows)."""
        leaf = self.feature < 0
        feature, cut, left = np.where(leaf, 0, self.feature), np.where(leaf, 256, self.cut), np.where(leaf, np.arange(len(leaf)), self.left)
        node, rows = np.zeros(bins.shape[1], dtype=np.int64), np.arange(bins.shape[1])
        for _ in range(self.depth):  # a leaf stays where it is
            node = left[node] + (bins[feature[node], rows] > cut[node])
        return self.shares[node].T


def sampled(u: np.ndarray, seed: int) -> np.ndarray:
    """How often each row (by its hash) is in a tree's sample."""
    return np.searchsorted(_POISSON, uniform(u, seed), side="right")


def _splits(bins: np.ndarray, rows: np.ndarray, node: np.ndarray, y: np.ndarray, w: np.ndarray, counts: np.ndarray, features: np.ndarray, least: int):
    """(feature or -1, bin) of each node's best split among its ``features``; ``node`` is the row's."""
    m, k = counts.shape
    total = counts.sum(axis=1)
    best = (counts**2).sum(axis=1) / total + 1e-9 * total
    found, cut = np.full(m, -1), np.zeros(m, dtype=np.int64)
    at, all_ = node * (BINS * k) + y, np.arange(m)
    for column in features.T:
        cells = at + bins[column[node], rows].astype(np.intp) * k
        left = np.bincount(cells, w, m * BINS * k).reshape(m, BINS, k).cumsum(axis=1)[:, :-1]
        right = counts[:, None, :] - left
        nl = left.sum(axis=2)
        nr = total[:, None] - nl
        score = (left**2).sum(axis=2) / np.maximum(nl, 1) + (right**2).sum(axis=2) / np.maximum(nr, 1)
        score[(nl < least) | (nr < least)] = -1.0
        b = score.argmax(axis=1)
        better = score[all_, b] > best + 1e-9  # else the smaller feature
        best = np.where(better, score[all_, b], best)
        found, cut = np.where(better, column, found), np.where(better, b, cut)
    return found, cut


def grow(bins: np.ndarray, y: np.ndarray, times: np.ndarray, classes: int, max_depth: int, least: int, subset: int, rng: np.random.Generator) -> GrownTree:
    """A tree on the rows of ``bins`` (features x rows), each counted ``times``."""
    rows = np.flatnonzero(times)
    node, made = np.zeros(len(rows), dtype=np.int64), 1  # the node of a row among the open ones; rows are in its order
    opened, columns, depth = np.zeros(1, dtype=np.int64), [], 0
    while True:
        m, own, w = len(opened), y[rows], times[rows].astype(float)
        counts = np.bincount(node * classes + own, w, m * classes).reshape(m, classes)
        feature, cut = np.full(m, -1), np.zeros(m, dtype=np.int64)
        if depth < max_depth and len(rows):
            starts = np.searchsorted(node, np.arange(m + 1))
            for s in range(0, m, CHUNK):
                e = min(m, s + CHUNK)
                part = slice(starts[s], starts[e])
                drawn = np.sort(rng.random((e - s, len(bins))).argpartition(subset - 1, axis=1)[:, :subset])
                feature[s:e], cut[s:e] = _splits(bins, rows[part], node[part] - s, own[part], w[part], counts[s:e], drawn, least)
        split = feature >= 0
        rank = np.cumsum(split) - 1
        columns.append((feature, cut, np.where(split, made + 2 * rank, 0), counts / np.maximum(counts.sum(axis=1), 1)[:, None]))
        if not split.any():
            break
        kept = split[node]
        rows, node = rows[kept], node[kept]
        node = 2 * rank[node] + (bins[feature[node], rows] > cut[node])
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        opened = np.arange(2 * int(split.sum()))
        made, depth = made + len(opened), depth + 1
    return GrownTree(*(np.concatenate(c) for c in zip(*columns)), depth)


def _columns(df: DataFrame, dims: int, *more) -> DataFrame:
    cells = vector_to_array("features")
    return df.select(*more, *[cells[i].alias(f"f{i}") for i in range(dims)])


def votes(train: DataFrame, keys: Sequence[str], rows: DataFrame, id_col: str, trees: Sequence[int], classes: int, max_depth: int,
          min_instances: int, subset: int, seed: int) -> DataFrame:
    """``id_col, votes``: the added-up class shares of the ``trees`` (numbers) grown on ``train`` (``label``, ``features``, ``keys``) for
    each of ``rows`` (a long ``id_col``, ``features``). Tasks hold all rows, about 60 bytes for each of both."""
    spark = train.sparkSession
    dims = train.select(F.size(vector_to_array("features")).alias("d")).first()["d"]
    cores = spark.sparkContext.defaultParallelism
    wide = cut_lineage(_columns(train, dims, F.xxhash64(*keys).alias("u"), F.col("label").cast("int").alias("y")))
    borders = bin_borders(wide, [f"f{i}" for i in range(dims)], BINS)
    asked = _columns(rows, dims, F.col(id_col).alias("u"), F.lit(-1).alias("y"))
    blocks = [
        cut_lineage(bin_rows(df, borders, partitions_for(df.count(), cores))).select(F.monotonically_increasing_id().alias("b"), F.lit(kind).alias("kind"), "u", "y", "bins")
        for kind, df in ((0, wide), (1, asked))
    ]
    groups = max(1, min(cores, len(trees)))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, g = ([], []), 0
        for batch in batches:
            for row in batch.to_pylist():
                held[row["kind"]].append(row)
                g = row["g"]
        if not held[0]:
            return
        own, asked = (sorted(h, key=lambda r: r["b"]) for h in held)

        def bins_of(some):
            return np.concatenate([np.frombuffer(r["bins"], dtype=np.uint8).reshape(dims, -1) for r in some], axis=1)

        u, y = (np.concatenate([np.frombuffer(r[c], dtype=t) for r in own]) for c, t in (("u", np.int64), ("y", np.int32)))
        bins = bins_of(own)
        order = np.lexsort((y, u))  # whatever the blocks
        u, y, bins = u[order], y[order].astype(np.intp), np.ascontiguousarray(bins[:, order])
        parts = [bins_of([r]) for r in asked]
        total = [np.zeros((classes, p.shape[1])) for p in parts]
        for t in trees[g::groups]:
            tree = grow(bins, y, sampled(u, seed + 7919 * t), classes, max_depth, min_instances, subset, np.random.default_rng([seed, t]))
            for sums, p in zip(total, parts):
                sums += tree.votes(p)
        for r, sums in zip(asked, total):
            yield pa.RecordBatch.from_arrays([pa.array([r["b"]], pa.int64()), pa.array([g], pa.int32()), pa.array([r["u"]], pa.binary()), pa.array([sums.tobytes()], pa.binary())], names=["b", "g", "u", "sums"])

    dealt = blocks[0].unionByName(blocks[1]).withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartitionByRange(groups, "g")
    parts = cut_lineage(in_arrow(dealt, step, "b long, g int, u binary, sums binary"))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(u, sums):
            ids, flat = np.frombuffer(u, dtype=np.int64), sums.T.ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, classes), pa.int32()), pa.array(flat))
            return pa.RecordBatch.from_arrays([pa.array(ids), lists], names=[id_col, "votes"])

        last = None
        for batch in batches:
            for row in batch.to_pylist():
                sums = np.frombuffer(row["sums"]).reshape(classes, -1)
                if last is not None and last[0] == row["b"]:
                    last = (last[0], last[1], last[2] + sums)
                    continue
                if last is not None:
                    yield out(*last[1:])
                last = (row["b"], row["u"], sums)
        if last is not None:
            yield out(*last[1:])

    return in_arrow(parts.repartition("b").sortWithinPartitions("b", "g"), added, f"{id_col} long, votes array<double>")
