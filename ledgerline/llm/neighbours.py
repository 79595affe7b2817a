"""Approximate nearest neighbours (operator 2): query-aware collision counting over sorted projections.

Vectors get one more component that makes them equally long (0 for queries), so that the largest inner
product is the smallest distance. Blocks of
about ``BLOCK`` vectors are indexed each by ``n_projections`` random projections, one sorted array per
projection. A query looks at the window around its own projection in every array; windows widen by
virtual rehashing (to the radius that the best vectors verified so far ask for), and a vector that falls into at least
``threshold`` windows is verified with the original vectors in double precision. A query's search of a
block ends when its k-th best verified distance is within R, for then every nearer vector has
collided often enough with probability ``1 - MISS``; there is no cap on candidates. The number of
projections and the threshold follow from ``MISS`` and the share ``FALSE`` of far vectors that may
be verified. Blocks of queries meet blocks of vectors in bounded tasks; the best of all blocks
are merged. Near vectors of unstructured data lie in all blocks, so every query has to meet every block: the work
is that of queries times vectors, and counts are taken from the smaller of a window and its complement.

Rows: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do rows without an id.
Vectors of one length are a collection of their own: a query is answered among those of its length. Rows with
equal ids are rows of their own, as queries and as candidates. Ties go to the smaller id. Fewer candidates than asked for:
all of them. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, erf, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.shared import mapped, runs, stored

#: Vectors of a block, queries of a group, and most groups (every vector is sent to each).
BLOCK, QUERIES, GROUPS = 32768, 1024, 4
RATIO, MISS, FALSE, SEED = 2.0, 0.05, 0.02, 7
#: Most partitions of tiles; further tiles share them.
MOST_PARTITIONS = 10_000
#: Places to each side in the smallest windows; first full radius, as a share of the one that these give.
FIRST, SHRINK = 48, 0.9


def parameters(miss: float = MISS, false: float = FALSE, ratio: float = RATIO) -> tuple[float, int, int]:
    """Window width for radius 1, number of projections, collision threshold."""
    width = sqrt(8 * ratio**2 * log(ratio) / (ratio**2 - 1))
    near, far = erf(width / 2 / sqrt(2)), erf(width / (2 * ratio) / sqrt(2))
    a, b = sqrt(log(2 / false)), sqrt(log(1 / miss))
    n = ceil((a + b) ** 2 / (2 * (near - far) ** 2))
    return width, n, ceil((a / b * near + far) / (1 + a / b) * n)


class Block:
    """One block's vectors and its sorted projections. ``rows`` tell rows apart, ``ids`` order ties."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, longest: float):
        self.rows, self.ids, self.vectors = rows, ids, np.ascontiguousarray(vectors)
        self.place = {r: i for i, r in enumerate(rows.tolist())}
        self.longest = longest
        self.width, n, self.threshold = parameters()
        self.directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1] + 1, n))
        extra = np.sqrt(np.maximum(longest - (vectors**2).sum(axis=1), 0))
        self.order = np.empty((n, len(ids)), dtype=np.intp)
        self.sorted = np.empty((n, len(ids)))
        for j, direction in enumerate(self.directions.T):
            projected = vectors @ direction[:-1] + extra * direction[-1]
            self.order[j] = np.argsort(projected, kind="stable")
            self.sorted[j] = projected[self.order[j]]

    def _collisions(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """In how many windows ``lo[j]:hi[j]`` each vector lies, counted inside or outside, whichever is less."""
        m, n = self.order.shape
        if 2 * int((hi - lo).sum()) <= m * n:
            return np.bincount(np.concatenate([row[i:j] for row, i, j in zip(self.order, lo.tolist(), hi.tolist())]), minlength=n)
        return m - np.bincount(np.concatenate([x for row, i, j in zip(self.order, lo.tolist(), hi.tolist()) for x in (row[:i], row[j:])]), minlength=n)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and inner products of the k best vectors other than the query's own row, best first."""
        n = len(self.ids)
        score, seen = np.full(n, -np.inf), np.zeros(n, dtype=bool)
        if own in self.place:
            seen[self.place[own]] = True
        if n <= k + 1:
            return self._best(np.flatnonzero(~seen), query, k)
        at = query @ self.directions[:-1]
        both = self.longest + float(query @ query)

        def verify(new: np.ndarray) -> float:
            """Verifies vectors; the radius that holds the k best verified so far."""
            seen[new] = True
            # where most are candidates, one product over the block is cheaper than picking them out
            score[new] = (self.vectors @ query)[new] if 4 * len(new) > n else self.vectors[new] @ query
            kth = np.partition(score, n - k)[n - k]
            # a query's extra component is 0, so the squared distance follows from the inner product alone
            return sqrt(max(both - 2 * float(kth), 0.0)) if np.isfinite(kth) else np.inf

        # the smallest windows give the first candidates, and these a radius that is wide enough
        middle = np.array([row.searchsorted(x) for row, x in zip(self.sorted, at.tolist())])
        lo, hi = np.maximum(middle - FIRST, 0), np.minimum(middle + FIRST, n)
        count = self._collisions(lo, hi)
        first = np.argpartition(-count, 4 * k)[: 4 * k] if n > 4 * k else np.arange(n)
        near = verify(first[~seen[first]])
        radius = near * SHRINK
        while True:
            half = radius * self.width / 2
            lo = np.minimum(lo, [row.searchsorted(x) for row, x in zip(self.sorted, (at - half).tolist())])
            hi = np.maximum(hi, [row.searchsorted(x, side="right") for row, x in zip(self.sorted, (at + half).tolist())])
            count = self._collisions(lo, hi)
            near = verify(np.flatnonzero((count >= self.threshold) & ~seen))
            if near <= radius or (lo == 0).all() and (hi == n).all():
                # rounding decides nothing: what is as good as the k-th up to rounding is compared by exact sums
                kth = np.partition(score, n - k)[n - k]
                return self._best(np.flatnonzero((score >= kth - 1e-9 * (1 + abs(kth))) & np.isfinite(score)), query, k)
            radius = min(near, radius * RATIO)

    def _best(self, at: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        score = (self.vectors[at] * query).sum(axis=1)
        order = np.lexsort((self.rows[at], self.ids[at], -score))[:k]
        return at[order], score[order]


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _searcher(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "tile"):
            asked = rows.column("asked").to_numpy()
            row, ids, vectors = rows.column("row").to_numpy(), rows.column("vec_id").to_numpy(), _matrix(rows.column("embedding"))
            if not asked.any() or asked.all():
                continue
            block = Block(row[~asked], ids[~asked], vectors[~asked], rows.column("longest")[0].as_py())
            out = [(q, i, *block.search(int(q), v, k)) for q, i, v in zip(row[asked], ids[asked], vectors[asked])]
            size = [len(at) for _, _, at, _ in out]
            at = np.concatenate([a for _, _, a, _ in out])
            columns = [np.repeat([q for q, *_ in out], size), np.repeat([i for _, i, *_ in out], size), block.rows[at], block.ids[at], np.concatenate([s for *_, s in out])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "query_id", "row", "vec_id", "score"])

    return search


def neighbours(vectors: DataFrame, asked: Column, k: int = 20, block: int = BLOCK, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``asked`` holds its k nearest other rows."""
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(asked, F.lit(False)).alias("is_asked"))
    limit = float(np.finfo(np.float64).max)
    finite = F.forall("embedding", lambda x: F.coalesce((x >= -limit) & (x <= limit), F.lit(False)))
    whole = whole.where("vec_id is not null and embedding is not null").where(finite & F.exists("embedding", lambda x: x != 0))
    # written once, so a row keeps its number
    whole = stored(whole.withColumns({"row": F.monotonically_increasing_id(), "d": F.size("embedding")}), "vectors")
    length = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    shares = whole.groupBy("d").agg(F.count("*").alias("n"), F.count_if("is_asked").alias("n_asked"), F.max(length).alias("longest"))
    blocks, groups = F.ceil(F.col("n") / block), F.least(F.lit(GROUPS), F.ceil(F.col("n_asked") / queries))
    shares = stored(shares.where("n_asked > 0").select("d", "longest", blocks.alias("blocks"), groups.alias("groups")), "shares")
    whole = whole.join(shares, "d")
    # every block of vectors meets every block of queries: each row goes to as many tiles as the other side has blocks
    base = whole.select("row", "vec_id", "embedding", "longest", "d", F.lit(False).alias("asked"), F.pmod(F.xxhash64("row"), "blocks").alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("other"))
    ask = whole.where("is_asked").select("row", "vec_id", "embedding", "longest", "d", F.lit(True).alias("asked"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("own"), F.pmod(F.xxhash64("row", F.lit(1)), "groups").alias("other"))
    tiles = base.union(ask).withColumn("tile", F.concat_ws(":", F.col("d").cast("string"), F.col("own").cast("string"), F.col("other").cast("string"))).drop("d", "own", "other")
    n_tiles = shares.agg(F.coalesce(F.sum(F.col("blocks") * F.col("groups")), F.lit(1))).first()[0]
    tiles = tiles.repartition(int(min(n_tiles, MOST_PARTITIONS)), "tile").sortWithinPartitions("tile")
    found = mapped(tiles, _searcher(k), "query long, query_id long, row long, vec_id long, score double")
    order = W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op2_collision_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
