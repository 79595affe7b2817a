"""Spelling variants (operator 11): words one edit apart, found by PartEnum signatures of letter multisets.

A word's letters form a binary vector with one dimension for each (letter, how often before in the word).
One inserted or deleted letter changes one dimension, a replaced letter two, so words one edit apart are
within Hamming distance two. PartEnum for that distance: the dimensions are dealt to ``PARTS`` parts;
two parts at most can differ, so for some choice of ``PARTS - 2`` parts the words agree on all of them.
Each choice gives one signature, and an equi-join on signatures finds every pair within the distance.

Anagrams share all signatures, so a signature is refined by two facts that one edit leaves alone. With L
the length of the shorter word, the words have lengths L and L or L + 1, and they share their first L // 2
code points or their last L - L // 2. Each signature is therefore given once for each half, with L the own
length and with L the own length less one. No pair is lost; what meets is verified by edit distance.

Dimensions are dealt so that parts carry about equal information, by how many words hold them (counted over
all words for letters' first ``COUNTED`` occurrences, 92 letters at most); others are dealt by their hash.

Rows: null and empty texts have no words; a null ``doc_id`` counts as the empty text in the hash that picks
the letters to delete; repeated rows count again. Other columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import mapped, mixed, stored

LEAST_LETTERS, LEAST_COUNT, DIVISOR = 5, 3, 97
PARTS = 4
#: Occurrences of a letter whose dimensions are dealt by counts.
COUNTED = 4
#: Text that one step counts, and distinct words that a task holds before it hands them on.
STEP, HELD = 1 << 20, 200_000

_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LETTERS)
_GAP = re.compile(rb"[^a-z\xc0-\xff]")
_CHOICES = list(combinations(range(PARTS), PARTS - 2))


def _pieces(data: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about ``STEP`` bytes that cut no run of letters."""
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + STEP) if len(data) - at > STEP else None
        to = gap.end() if gap else len(data)
        yield data[at:to]
        at = to


def words_of_text(doc_id: str, text: str) -> Iterator[tuple[bytes, int]]:
    """Words (Latin-1 bytes, one for each code point) and counts of one text, letter deletions applied."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    for piece in _pieces(text.encode("latin-1", "replace").lower()):
        for run, n in Counter(_RUN.findall(piece)).items():
            h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
            if not h % DIVISOR:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
                if len(run) < LEAST_LETTERS:
                    continue
            yield run, n


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def out():
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        batch = pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
            for word, n in words_of_text(doc_id.as_py(), text.as_py()):
                held[word] += n
                if len(held) >= HELD:
                    yield out()
    if held:
        yield out()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` for the words of all texts of ``docs(doc_id, text)`` that occur ``LEAST_COUNT`` times or more."""
    texts = docs.where("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return mapped(texts, _counter, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _dimensions(word: str) -> list[tuple[str, int]]:
    seen: Counter = Counter()
    out = []
    for c in word:
        out.append((c, seen[c]))
        seen[c] += 1
    return out


def _holders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()
    for batch in batches:
        for word in batch.column("word").to_pylist():
            held.update(d for d in _dimensions(word) if d[1] < COUNTED)
    if held:
        letters, places = zip(*held)
        yield pa.RecordBatch.from_arrays([pa.array(letters, pa.string()), pa.array(places, pa.int32()), pa.array(held.values(), pa.int64())], names=["letter", "place", "n"])


def deal(holders: dict[tuple[str, int], int], words: int) -> dict[tuple[str, int], int]:
    """The part of each dimension: those of most information first, each to the part with least so far."""

    def bits(n: int) -> float:
        p = n / words
        return -(p * log(p) + (1 - p) * log(1 - p)) if 0 < p < 1 else 0.0

    load, part = [0.0] * PARTS, {}
    for d in sorted(holders, key=lambda d: (-bits(holders[d]), d)):
        part[d] = min(range(PARTS), key=load.__getitem__)
        load[part[d]] += bits(holders[d])
    return part


def signatures(words: list[str], part: dict[tuple[str, int], int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys (word, choice of parts and half) of ``words``, and whether a key is one of the own length."""
    known: dict[tuple[str, int], tuple[int, int]] = {}
    sums = np.zeros((len(words), PARTS), dtype=np.uint64)
    halves = np.zeros((len(words), 4), dtype=np.uint64)
    for i, word in enumerate(words):
        own = [0] * PARTS
        for d in _dimensions(word):
            if d not in known:
                h = xxhash.xxh64_intdigest(f"{d[0]}{d[1]}".encode())
                known[d] = part.get(d, h % PARTS), h
            p, h = known[d]
            own[p] += h
        sums[i] = [s & 0xFFFFFFFFFFFFFFFF for s in own]
        n = len(word)
        for j, short in enumerate((n, n - 1)):
            halves[i, 2 * j] = xxhash.xxh64_intdigest(f"{short}<{word[: short // 2]}".encode())
            halves[i, 2 * j + 1] = xxhash.xxh64_intdigest(f"{short}>{word[n - (short - short // 2) :]}".encode())
    keys = np.empty((len(words), len(_CHOICES), 4), dtype=np.uint64)
    for c, chosen in enumerate(_CHOICES):
        key = np.full(len(words), c + 1, dtype=np.uint64)
        for p in chosen:
            key = mixed(key + sums[:, p])
        keys[:, c] = mixed(key[:, None] ^ halves)
    return keys.reshape(len(words), -1).view(np.int64), np.tile([True, True, False, False], len(_CHOICES))


def _signer(part: dict[tuple[str, int], int]):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                rows = batch.slice(at, 4096)
                keys, own = signatures(rows.column("word").to_pylist(), part)
                each = pa.array(np.repeat(np.arange(len(rows)), keys.shape[1]))
                flags = pa.array(np.tile(own.astype(np.int8), len(rows)))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), flags, rows.column("word").take(each), rows.column("n").take(each)], names=["key", "own", "word", "n"])

    return sign


def near_words(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of ``words(word, n)`` (stored) that one edit turns into each other, once, a < b."""
    counts = mapped(words.select("word"), _holders, "letter string, place int, n long").groupBy("letter", "place").agg(F.sum("n").alias("n"))
    part = deal({(r.letter, r.place): r.n for r in counts.collect()}, max(1, words.count()))
    signed = mapped(words, _signer(part), "key long, own byte, word string, n long")
    a, b = signed.alias("a"), signed.alias("b")  # the same exchange serves both sides
    met = (F.col("a.key") == F.col("b.key")) & (F.col("a.word") < F.col("b.word")) & (F.col("a.own") + F.col("b.own") > 0)
    close = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    pairs = a.join(b.hint("merge"), met & close).select(F.col("a.word").alias("a"), F.col("a.n").alias("a_n"), F.col("b.word").alias("b"), F.col("b.n").alias("b_n"))
    return pairs.distinct()


def spelling_forms(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every row of ``words(word, n)``, distinct words.

    ``form`` is the near word of largest count (ties: smallest), if that is at least twice the word's own.
    Counts at least double along forms, so ``root`` is reached by few doublings of the way.
    """
    words = stored(words.select("word", "n"), "words")
    pairs = near_words(words)
    both = stored(pairs.union(pairs.select("b", "b_n", "a", "a_n")), "near") if words.limit(1).count() else pairs
    best = both.groupBy("a").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("word"))).alias("best"))
    joined = words.join(best, words.word == best.a, "left")
    is_form = -F.col("best.less") >= 2 * F.col("n")
    forms = stored(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")),
        "forms",
    )
    most = forms.agg(F.max("n")).first()[0] or 1
    way = forms.where("form is not null").select("word", F.col("form").alias("top"))
    for _ in range(ceil(log2(max(1.0, log2(max(2, most)))))):
        further = way.select(F.col("word").alias("w"), F.col("top").alias("t"))
        way = stored(way.join(further, way.top == further.w, "left").select("word", F.coalesce("t", "top").alias("top")), "way")
    roots = way.select(F.col("word").alias("w"), F.col("top").alias("root"))
    return forms.join(roots, forms.word == roots.w, "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(word_counts(spark.read.parquet(f"{sf_dir}/documents.parquet")))
