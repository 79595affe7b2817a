"""What the operators of this package have in common: shared storage, text batches, word hashes."""

from __future__ import annotations

import contextlib
import ctypes
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Text bytes that one numpy step works on; a longer document is a step of its own.
STEP_BYTES = 1 << 20

_local_folders: dict[str, str] = {}
_sent: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which driver and executors share.

    Unset, a local master (tests) gets a temporary folder; on a cluster that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "local").startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="llm-shared-")
    return _local_folders[app]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the lineage ends there,
    a lost executor costs nothing that was written, and later steps read only their columns."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """What this process holds without need goes back to the system."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries give memory back by themselves
        ctypes.CDLL(None).malloc_trim(0)


def mapped(df: DataFrame, step: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow(step, schema)`` after this library's code was sent to the executors (once per application).

    Python workers outlive their tasks; each task ends by giving the memory it freed back to the system.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    context = df.sparkSession.sparkContext
    if context.applicationId not in _sent:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{os.path.basename(package)}", "zip", os.path.dirname(package), os.path.basename(package))
        context.addPyFile(archive)
        _sent.add(context.applicationId)
    return df.mapInArrow(run, schema)


def unused(columns: list[str], *names: str) -> list[str]:
    """``names``, each lengthened by underscores until no column has it (column names differ in more than case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` (stored, narrow rows) marked for broadcast if it has at most ``rows`` rows; else
    unmarked, so that the join shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def crc_mod(doc_id: str | Column, m: int) -> Column:
    """crc32 of the id as text, mod ``m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"), F.lit("")).cast("binary")) % m


def text_steps(batch: pa.RecordBatch, column: str = "text", step: int = STEP_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of ``batch`` with about ``step`` bytes of text each, and their texts with nulls as empty."""
    texts = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + step, side="right")))
        yield batch.slice(at, to - at), texts.slice(at, to - at)
        at = to


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _UNBASE)):
            table = np.full(n, base, dtype=np.uint64)
            table[0] = 1
            _powers[name] = np.cumprod(table, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values, so that all bits depend on all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (large_string, no nulls) in a row, and each text's bounds in them."""
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or bounds[0] == bounds[-1]:
        return np.zeros(0, dtype=np.uint8), bounds - bounds[0]
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes: polynomials taken from prefix sums over all bytes at once."""
    up, down = _power_table(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start])


_PLACE = mixed(np.arange(101, 165, dtype=np.uint64)) | np.uint64(1)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of A-Z-lowered texts, and each text's bounds in them."""
    data, bounds = text_bytes(texts)
    n = len(data)
    if not n:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts) + 1, dtype=np.int64)
    low = _LOWER[data]
    space = _SPACE[low]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    before, after = np.empty(n, dtype=bool), np.empty(n, dtype=bool)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    start = np.flatnonzero(~space & (before | edge[:-1]))
    end = np.flatnonzero(~space & (after | edge[1:])) + 1
    return span_hashes(low, start, end), np.searchsorted(start, bounds)


def shingle_hashes(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Distinct hashes of the ``size``-word shingles of one text, sorted; fewer words count as one shingle."""
    if not len(words):
        return words
    k = min(size, len(words))
    h = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        h += words[j : j + len(h)] * _PLACE[j]
    h = mixed(h)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of each run of equal values of ``column``, across batches; one run is held at a time."""
    held: list[pa.Table] = []
    for batch in batches:
        if not len(batch):
            continue
        table = pa.Table.from_batches([batch])
        values = table.column(column).combine_chunks()
        cuts = [0, *(np.flatnonzero(pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)) + 1).tolist(), len(values)]
        for i, (s, e) in enumerate(zip(cuts[:-1], cuts[1:])):
            if i or not held or held[-1].column(column)[0] != values[0]:
                if held:
                    yield pa.concat_tables(held)
                held = []
            held.append(table.slice(s, e - s))
    if held:
        yield pa.concat_tables(held)


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of one A-Z-lowered text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def ranked(df: DataFrame, group: str, order: str, name: str = "rank", buckets: int = 64) -> DataFrame:
    """``df`` with a long ``name``: 0, 1, 2... within each value of ``group``.

    Rows are numbered within (group, hash bucket of ``order``) and shifted by the counts of the
    buckets before, so that no task holds a whole group. Equal ``order`` values fall into one bucket.
    """
    from pyspark.sql import Window as W

    df = df.withColumn("_b", F.pmod(F.xxhash64(order), F.lit(buckets)).cast("int"))
    counts = df.groupBy(group, "_b").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select(F.col(group).alias("_g"), F.col("_b").alias("_sb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = W.partitionBy(group, "_b").orderBy(order)
    numbered = df.withColumn("_r", F.row_number().over(own).cast("long") - 1)
    return (
        numbered.join(shift, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_b") == F.col("_sb")))
        .withColumn(name, F.col("_r") + F.col("_before"))
        .drop("_b", "_g", "_sb", "_r", "_before")
    )
