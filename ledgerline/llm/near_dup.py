"""Near duplicates (operator 5): banded MinHash candidates, sequential Bayesian pruning, exact verification.

Documents with the same word sequence form a class, and only classes are compared. Bands of a
128-value MinHash signature give candidate buckets. In a bucket every class is compared with the
bucket's leader first; links found so far are joined into components, and further rounds compare
only classes of one bucket that are in different components, so a large group of copies costs
about one comparison per member and bucket. The last round compares all that are still apart.

A candidate pair's signatures are compared 32 values at a time. With a uniform prior on the
similarity, the chance that it reaches the threshold after m matches in n is that of at most m
successes in n + 1 draws at the threshold; a pair is dropped when this is below ``miss``. What
survives is verified on the full shingle sets; texts travel only for classes of surviving pairs.

Rows: null, empty and blank texts have no shingles and link with nothing (component: their own id).
Repeated rows are copies of each other. A null ``doc_id`` never names a component while its
component has another id; the row links as any other. Other columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.components import connected_components
from ledgerline.llm.shared import mapped, mixed, runs, shingle_hashes, small_side, stored, text_steps, unused, word_hashes, words_of

SIZE, ROWS, BANDS, HASHES, BATCH = 5, 5, 25, 128, 32
MISS = 1e-4
#: Class rows (about 60 bytes) up to which their keys are broadcast to pick texts; beyond, the join shuffles.
BROADCAST_CLASSES = 200_000
#: Members of one tile; a bucket of n members is compared as pairs of its ceil(n / TILE) tiles.
TILE = 1024
#: Shingle sets that a task holds at a time.
HELD_SETS = 256

_SEED = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_MUL, _ADD = (_SEED[:HASHES] | np.uint64(1))[:, None], _SEED[HASHES:][:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """128 MinHash values (32 bits) of a set of 64-bit shingle hashes."""
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint64)
    for i in range(0, len(shingles), 4096):
        h = shingles[None, i : i + 4096] * _MUL
        h += _ADD
        np.minimum(out, h.min(axis=1) >> np.uint64(32), out=out)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_steps(batch):
            words, at = word_hashes(texts)
            cls, count, sigs, bands = [], [], [], []
            for s, e in zip(at[:-1], at[1:]):
                if s == e:
                    cls.append(None), count.append(0), sigs.append(None), bands.append(None)
                    continue
                shingles = shingle_hashes(words[s:e], SIZE)
                sig = signature(shingles)
                rows = sig[: ROWS * BANDS].reshape(BANDS, ROWS)
                key = np.arange(1, BANDS + 1, dtype=np.uint64)
                for j in range(ROWS):
                    key = mixed(key + rows[:, j])
                cls.append(xxhash.xxh3_128_digest(words[s:e].tobytes()))
                count.append(len(shingles))
                sigs.append(sig.astype("<u2").tobytes())
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("tkey"), pa.array(cls, pa.binary()), pa.array(count, pa.int64()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "tkey", "cls", "n_shingles", "sig", "bands"],
            )


def least_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """(n, least m): with fewer than m matches in the first n values a pair is dropped."""
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while chance < miss:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append((n, m))
    return out


def _sequential(sig: np.ndarray, a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (rows ``a`` and ``b`` of ``sig``) that pass every step, and their matches."""
    matches, begin = np.zeros(len(a), dtype=np.int64), 0
    for n, least in steps:
        for i in range(0, len(a), 65536):
            part = slice(i, i + 65536)
            matches[part] += (sig[a[part], begin:n] == sig[b[part], begin:n]).sum(axis=1)
        alive = matches >= least
        a, b, matches, begin = a[alive], b[alive], matches[alive], n
    return a, b, matches


def _pruner(threshold: float, miss: float):
    steps = least_matches(threshold, miss)

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            n = len(batch)
            sig = np.frombuffer(b"".join(batch.column("sig_a").to_pylist() + batch.column("sig_b").to_pylist()), dtype="<u2").reshape(-1, HASHES)
            alive = pa.array(_sequential(sig, np.arange(n), np.arange(n, 2 * n), steps)[0])
            if len(alive):
                yield pa.RecordBatch.from_arrays([batch.column("a").take(alive), batch.column("b").take(alive)], names=["a", "b"])

    return prune


def shingle_set(text: str | None, size: int = SIZE) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def _verifier(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()  # pairs of one leader come in a row
        for batch in batches:
            keep = []
            for i in range(len(batch)):
                leader = batch.column("a")[i].as_py()
                if leader != last:
                    last, own = leader, shingle_set(batch.column("text_a")[i].as_py())
                if similar(own, shingle_set(batch.column("text_b")[i].as_py()), percent):
                    keep.append(i)
            if keep:
                yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(keep)), batch.column("b").take(pa.array(keep))], names=["a", "b"])

    return verify


def similar(a: set, b: set, percent: int) -> bool:
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _tile_pairs(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of two tiles (or within one) in different components whose first shared band is this bucket's."""
    bands = np.stack(rows.column("bands").to_pylist())
    root = np.unique(np.array([r.hex() for r in rows.column("root").to_pylist()]), return_inverse=True)[1]
    tile, band = rows.column("tile").to_numpy(), rows.column("band")[0].as_py()
    at = np.arange(len(bands))
    one = tile.min() == tile.max()
    left, right = (at, at) if one else (at[tile == tile.min()], at[tile == tile.max()])
    a, b = [], []
    for i in range(0, len(left), 128):
        mine = left[i : i + 128]
        near = root[mine][:, None] != root[right][None, :]
        if one:
            near &= mine[:, None] < right[None, :]
        for k in range(band):
            near &= bands[mine, k][:, None] != bands[right, k][None, :]
        x, y = np.nonzero(near)
        a.append(mine[x]), b.append(right[y])
    return np.concatenate(a), np.concatenate(b)


def _tile_sieve(threshold: float, miss: float):
    """The rows of each tile pair that have a partner whose signature survives every step."""
    steps = least_matches(threshold, miss)

    def sieve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "g"):
            a, b = _tile_pairs(rows)
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), dtype="<u2").reshape(-1, HASHES)
            a, b, _ = _sequential(sig, a, b, steps)
            if len(a):
                yield from rows.take(np.union1d(a, b)).combine_chunks().to_batches()

    return sieve


def _tile_linker(percent: int, miss: float):
    steps = least_matches(percent / 100, miss)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, "g"):
            a, b = _tile_pairs(rows)
            sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), dtype="<u2").reshape(-1, HASHES)
            out: list[tuple[bytes, bytes]] = []
            a, b, matches = _sequential(sig, a, b, steps)
            order = np.argsort(-matches, kind="stable")
            cls, root, text = (rows.column(c).to_pylist() for c in ("cls", "root", "text"))
            up = {r: r for r in root}

            def top(r):
                while up[r] != r:
                    up[r] = r = up[up[r]]
                return r

            sets: dict[int, set] = {}
            for x, y in zip(a[order].tolist(), b[order].tolist()):
                p, q = top(root[x]), top(root[y])
                if p == q:
                    continue
                if len(sets) > HELD_SETS:
                    sets.clear()
                for i in (x, y):
                    if i not in sets:
                        sets[i] = shingle_set(text[i])
                if similar(sets[x], sets[y], percent):
                    up[max(p, q)] = min(p, q)
                    out.append((cls[x], cls[y]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])

    return link


def linked(docs: DataFrame, percent: int = 85, miss: float = MISS) -> DataFrame:
    """``doc_id, tkey, cls, n_shingles, component_id, root`` for every row of ``docs(doc_id, text)``.

    Links are pairs with ``100 * shared >= percent * union`` distinct 5-word shingles. ``tkey`` is the
    text's ``xxhash64``; ``root`` identifies the component (null for texts without words).
    """
    source = docs.select("doc_id", "text").withColumn("tkey", F.xxhash64(F.coalesce("text", F.lit(""))))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tkey long, cls binary, n_shingles long, sig binary, bands array<long>"
    signed = stored(mapped(source, _sign, schema), "signed")
    worded = signed.where("cls is not null")
    classes = stored(
        worded.groupBy("cls").agg(F.min(F.struct("doc_id", "tkey")).alias("rep"), F.any_value("sig").alias("sig"), F.any_value("bands").alias("bands"), F.min("doc_id").alias("first_id")),
        "classes",
    )
    members = classes.select("cls", F.posexplode("bands").alias("band", "key"))
    shared = members.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(members.join(shared.drop("n"), ["band", "key"]), "members")
    # what the rounds compare: only classes that share a bucket with another
    active = stored(classes.join(members.select("cls").distinct(), "cls").select("cls", "rep", "sig", "bands"), "active")

    def texts(wanted: DataFrame) -> DataFrame:
        """``cls, text`` of the classes ``wanted(cls)``."""
        needed = stored(wanted.distinct().join(active, "cls").select("cls", "rep.doc_id", "rep.tkey"), "needed").toDF("cls", "rep_id", "rep_key")
        own = source.doc_id.eqNullSafe(F.col("rep_id")) & (source.tkey == F.col("rep_key"))
        return stored(source.join(small_side(needed, BROADCAST_CLASSES), own).select("cls", "text"), "texts").dropDuplicates(["cls"])

    # first round: each class of a bucket against the bucket's leader
    first = members.groupBy("band", "key").agg(F.min("cls").alias("a"))
    pairs = first.join(members, ["band", "key"]).select("a", F.col("cls").alias("b")).where("a <> b").distinct()
    sig = active.select("cls", "sig")
    both = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
    left = stored(mapped(both, _pruner(percent / 100, miss), "a binary, b binary"), "survivors")
    full = texts(left.select(F.col("a").alias("cls")).union(left.select("b")))
    full = left.join(full.toDF("b", "text_b"), "b").join(full.toDF("a", "text_a"), "a")
    links = stored(mapped(full, _verifier(percent), "a binary, b binary"), "found")

    # second round: tiles of the buckets that still hold several components (of equal buckets, the first)
    roots = connected_components(links)
    labelled = members.join(roots, members.cls == roots.node, "left").select("band", "key", "cls", F.coalesce("root", "cls").alias("root"))
    split = labelled.groupBy("band", "key").agg(
        F.count("*").alias("n"), F.min("root").alias("r"), F.max("root").alias("s"), F.bit_xor(F.xxhash64("cls")).alias("h"), F.min("cls").alias("lo"), F.max("cls").alias("hi")
    )
    split = split.where("r <> s").groupBy("n", "h", "lo", "hi").agg(F.min(F.struct("band", "key")).alias("at")).select("at.*", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    apart = stored(labelled.join(split, ["band", "key"]).withColumn("tile", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")), "apart")
    spread = apart.withColumn("t", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    spread = spread.withColumn("g", F.concat_ws(":", "band", "key", F.least("tile", "t"), F.greatest("tile", "t"))).drop("t", "tiles", "key")
    tiles = spread.join(active.drop("rep"), "cls").select("g", "cls", "root", "tile", "band", "sig", "bands").repartition("g").sortWithinPartitions("g")
    # signatures decide first, so that only the texts of pairs that survive are sent to their tiles
    near = stored(mapped(tiles, _tile_sieve(percent / 100, miss), tiles.schema), "near")
    tiles = near.join(texts(near.select("cls")), "cls").repartition("g").sortWithinPartitions("g")
    links = stored(links.union(mapped(tiles, _tile_linker(percent, miss), "a binary, b binary")), "found")

    roots = connected_components(links)
    placed = classes.join(roots, classes.cls == roots.node, "left").select("cls", "first_id", F.coalesce("root", "cls").alias("root"))
    ids = placed.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("component_id"))
    placed = stored(placed.join(ids, F.col("root") == F.col("r")).select(F.col("cls").alias("c"), "component_id", "root"), "placed")
    rows = signed.select("doc_id", "tkey", "cls", "n_shingles").join(placed, F.col("cls") == F.col("c"), "left").drop("c")
    return rows.withColumn("component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))


def near_duplicates(docs: DataFrame, percent: int = 85, miss: float = MISS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest ``doc_id`` reachable over links, the own one included; ``kept`` says
    whether that is the row's own.
    """
    return linked(docs, percent, miss).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, percent: int = 80, miss: float = MISS) -> DataFrame:
    """Rows of ``docs`` without near duplicates: one row of each group stays, all texts without words stay.

    The row with the smallest id stays; of several rows that share this id, the one with the smallest text hash.
    """
    rows = linked(docs, percent, miss)
    own = F.struct("doc_id", "tkey")
    best = stored(rows.where("root is not null").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(own).alias("k"), F.count("*").alias("n")), "kept")
    key, k_id, k_key, n = unused(docs.columns, "text_key", "kept_id", "kept_key", "copies")
    keys = best.select(F.col("k.doc_id").alias(k_id), F.col("k.tkey").alias(k_key), F.col("n").alias(n))
    sourced = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    blank = ~F.coalesce("text", F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    same = F.col("doc_id").eqNullSafe(F.col(k_id)) & (F.col(key) == F.col(k_key))
    # keys as many as the documents kept: dealt by key at every size; the narrow side is hashed, texts are not sorted
    kept = sourced.join(keys.hint("shuffle_hash"), same).select(*docs.columns, n)
    once = kept.where(F.col(n) == 1).drop(n)
    repeated = kept.where(F.col(n) > 1).drop(n).dropDuplicates(["doc_id", "text"])
    return once.unionByName(repeated).unionByName(docs.where(blank))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
