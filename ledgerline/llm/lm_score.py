"""Language-model scoring (operator 10): prediction by partial matching over bytes, trained on the corpus.

The model is the byte-context trie of all training documents, kept as counts of (context, byte) at orders
``ORDER`` down to 0. A byte that its context has seen costs its share of the context's counts; else
the context pays an escape (method C: as many counts as it has different bytes) and the next
shorter context decides among the bytes that the longer one has not seen (exclusion). A context
never seen costs nothing. Below order 0 all unseen byte values are equally likely. A document's
text is preceded by ``ORDER`` start marks (byte 0xFE) and followed by an end mark (0xFF), which
UTF-8 never uses.

For a trained model the cost of a byte depends on its context alone, so a document's code length is a
sum over its distinct (ORDER + 1)-grams. One pass over all documents counts words and grams, those of
held-out documents as zero; the costs of all grams met are then found level by level, one join with the
contexts of an order at a time, each context a row with its bytes and their counts. Frequent grams and words
(chosen by count, at most ``FREQUENT_GRAMS`` and ``FREQUENT_WORDS`` of them) go to the executors as a
broadcast table; the others of each document are looked up by shuffled joins. Everything is counted over
all training documents. Words are told apart by their 64-bit hashes.

Rows: null or empty text: one token (the end), the score of the end mark alone. Repeated rows each get
their row; null ids are ids like any other. Without training rows every byte costs log10 of 1/256 and the
base score is that of zero counts. Other columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import crc_mod, mapped, stored, text_bytes, text_steps, word_hashes

ORDER = 5
START, END = 0xFE, 0xFF
FREQUENT_WORDS, FREQUENT_GRAMS = 1 << 16, 1 << 20
#: Distinct words and grams that a task gathers before it hands its counts on, and text that a step counts.
HELD_COUNTS, STEP = 1 << 20, 1 << 20
#: Kinds of counted keys: grams, words, texts.
GRAM, WORD, TEXT = 0, 1, 2


def grams(texts: pa.Array, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """The (order + 1)-grams of marked texts as integers, and each text's bounds in them."""
    data, bounds = text_bytes(texts)
    size = np.diff(bounds)
    buf = np.full(len(data) + (order + 1) * len(size), START, dtype=np.uint8)
    at = np.arange(len(size))
    buf[np.arange(len(data)) + np.repeat((order + 1) * at + order, size)] = data
    buf[bounds[1:] + (order + 1) * at + order] = END
    key = np.zeros(len(buf) - order, dtype=np.int64)
    for j in range(order + 1):
        key = (key << 8) | buf[j : j + len(key)]
    own = np.ones(len(key), dtype=bool)
    joints = (bounds[1:-1] + (order + 1) * at[1:])[:, None] - 1 - np.arange(order)
    own[joints] = False
    return key[own], bounds + np.arange(len(bounds))


class _Counts:
    """Sorted keys and their counts; merging two sorted runs is linear."""

    def __init__(self):
        self.keys, self.n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def add(self, keys: np.ndarray, weight: int) -> None:
        """Counts each of ``keys`` as ``weight`` (0: only that it occurs)."""
        code, found = pd.factorize(keys)
        n = np.bincount(code, minlength=len(found)) * weight
        order = np.argsort(found)
        both = np.concatenate([self.keys, found[order]])
        n = np.concatenate([self.n, n[order]])
        order = np.argsort(both, kind="stable")
        both = both[order]
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, dtype=np.int64)
        self.keys, self.n = both[first], np.add.reduceat(n[order], first) if len(first) else n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts (kind, key, n) of a task's texts; what only held-out texts have counts zero."""
    held = {GRAM: _Counts(), WORD: _Counts()}
    texts_seen = 0

    def flush():
        parts = [(GRAM, held[GRAM].keys, held[GRAM].n), (WORD, held[WORD].keys, held[WORD].n), (TEXT, np.zeros(1, dtype=np.int64), np.array([texts_seen]))]
        kinds = np.concatenate([np.full(len(k), kind, dtype=np.int8) for kind, k, _ in parts])
        return pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(np.concatenate([k for _, k, _ in parts])), pa.array(np.concatenate([n for *_, n in parts]).astype(np.int64))], names=["kind", "key", "n"])

    for batch in batches:
        for part, texts in text_steps(batch, step=STEP):
            out = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            for weight, rows in ((1, np.flatnonzero(~out)), (0, np.flatnonzero(out))):
                if not len(rows):
                    continue
                own = texts.take(pa.array(rows))
                held[GRAM].add(grams(own)[0], weight)
                if weight:
                    held[WORD].add(word_hashes(own)[0].view(np.int64), 1)
                    texts_seen += len(rows)
            if len(held[GRAM].keys) + len(held[WORD].keys) > HELD_COUNTS:
                yield flush()
                held, texts_seen = {GRAM: _Counts(), WORD: _Counts()}, 0
    yield flush()


def _frequent(counts: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` rows of ``counts`` have ``n`` of that or more."""
    sizes = dict(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).agg(F.count("*")).collect())  # at most 63 rows
    total, at = 0, 63
    for k in sorted(sizes, reverse=True):
        total += sizes[k]
        if total > most:
            break
        at = k
    return 1 << at


def _contexts(counted: DataFrame) -> list[DataFrame]:
    """For orders 0 to ORDER: per context its total, different bytes, what these count one order lower, and ``seen``,
    an array of (byte, n) with 256 entries at most."""
    out: list[DataFrame] = []
    shorter = None
    for order in range(ORDER + 1):
        mask = (1 << 8 * (order + 1)) - 1
        own = counted if order == ORDER else stored(counted.groupBy(F.col("gram").bitwiseAND(mask).alias("gram")).agg(F.sum("n").alias("n")), f"grams{order}")
        both = own.withColumn("low_n", F.lit(0)) if shorter is None else own.join(shorter, F.col("gram").bitwiseAND(mask >> 8) == F.col("low"))
        byte = F.col("gram").bitwiseAND(255).cast("short")
        contexts = both.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("low_n").alias("low_total"), F.map_from_entries(F.collect_list(F.struct(byte, "n"))).alias("seen")
        )
        out.append(stored(contexts, f"contexts{order}"))
        shorter = own.toDF("low", "low_n")
    return out


def _costs(keys: DataFrame, contexts: list[DataFrame]) -> DataFrame:
    """``(gram, cost)``: log10 of each gram's probability, from the longest context down, one join for each order."""
    state = keys.select("gram").withColumns({"cost": F.lit(None).cast("double"), "paid": F.lit(0.0), "out_total": F.lit(0).cast("long"), "out_kinds": F.lit(0).cast("long")})
    for order in range(ORDER, -1, -1):
        mask = (1 << 8 * (order + 1)) - 1
        state = state.join(contexts[order], F.shiftright(F.col("gram").bitwiseAND(mask), 8) == F.col("context"), "left")
        own_n = F.try_element_at("seen", F.col("gram").bitwiseAND(255).cast("short"))
        room = F.col("total") - F.col("out_total") + F.col("kinds") - F.col("out_kinds")
        left = F.col("kinds") - F.col("out_kinds")
        known = F.col("context").isNotNull()
        state = state.select(
            "gram",
            F.when(F.col("cost").isNotNull(), F.col("cost")).when(own_n.isNotNull(), F.col("paid") + F.log10(own_n / room)).alias("cost"),
            F.when(known & (left > 0), F.col("paid") + F.log10(left / room)).otherwise(F.col("paid")).alias("paid"),
            F.when(known, F.col("low_total")).otherwise(F.lit(0)).alias("out_total"),
            F.when(known, F.col("kinds")).otherwise(F.lit(0)).alias("out_kinds"),
        )
    unseen = F.greatest(F.lit(256) - F.col("out_kinds"), F.lit(1))
    return state.select("gram", F.coalesce("cost", F.col("paid") - F.log10(unseen)).alias("cost"))


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``wanted`` are among the sorted ``keys``, and their values (0 for the others)."""
    if not len(keys):
        return np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted))
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    hit = keys[at] == wanted
    return hit, np.where(hit, values[at], 0.0)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between ``bounds``; empty ranges are 0."""
    upto = np.add.reduceat(np.append(values, 0), bounds[:-1]) if len(bounds) > 1 else np.zeros(0)
    return np.where(np.diff(bounds) > 0, upto, 0)


def _rare(code: np.ndarray, found: np.ndarray, hit: np.ndarray, bounds: np.ndarray, name: str) -> pa.Array:
    """Per text a list of (key, times) of the keys that were not looked up."""
    miss = np.flatnonzero(~hit[code])
    doc = np.searchsorted(bounds, miss, side="right") - 1
    pair, n = np.unique(doc * max(1, len(found)) + code[miss], return_counts=True)
    cuts = np.searchsorted(pair // max(1, len(found)), np.arange(len(bounds)))
    rows = pa.StructArray.from_arrays([pa.array(found[pair % max(1, len(found))]), pa.array(n, pa.int64())], [name, "times"])
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), rows)


def _scorer(shared):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_keys, word_costs, keys, costs = shared.value
        for batch in batches:
            for part, texts in text_steps(batch, step=STEP >> 1):
                key, bounds = grams(texts)
                code, found = pd.factorize(key)
                hit, cost = _looked_up(keys, costs, found)
                words, at = word_hashes(texts)
                word_code, word_found = pd.factorize(words.view(np.int64))
                word_hit, word_cost = _looked_up(word_keys, word_costs, word_found)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"), part.column("doc_id"), part.column("held_out"),
                        pa.array(np.diff(at) + 1, pa.int64()), pa.array(_sums(word_hit[word_code].astype(np.int64), at), pa.int64()),
                        pa.array(_sums(word_cost[word_code], at), pa.float64()), pa.array(_sums(cost[code], bounds), pa.float64()),
                        _rare(word_code, word_found, word_hit, at, "word"), _rare(code, found, hit, bounds, "gram"),
                    ],
                    names=["row", "doc_id", "held_out", "n_tokens", "known", "base", "cost", "words", "grams"],
                )

    return score


def score(docs: DataFrame, held_out) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held_out``: a boolean column; rows where it is false train. ``score`` is the log10 probability of the text
    under the model, ``base_score`` that of its words under smoothed unigram counts.
    """
    spark = docs.sparkSession
    counted = mapped(docs.select(F.coalesce(held_out, F.lit(True)).alias("held_out"), "text"), _count, "kind byte, key long, n long")
    counted = stored(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")
    words = counted.where(F.col("kind") == WORD).select(F.col("key").alias("word"), "n")
    met = counted.where(F.col("kind") == GRAM).select(F.col("key").alias("gram"), "n")
    gram_counts = met.where("n > 0")
    ends = counted.where(F.col("kind") == TEXT).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_words, kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, kinds = n_words + ends, kinds + (ends > 0)
    share = float(np.log10(total + 0.5 * (kinds + 1)))

    costs = stored(_costs(met, _contexts(gram_counts)).join(met, "gram"), "costs")
    often = costs.where(F.col("n") >= _frequent(gram_counts, FREQUENT_GRAMS)).select("gram", "cost").toArrow().sort_by("gram")  # at most FREQUENT_GRAMS rows
    common = words.where(F.col("n") >= _frequent(words, FREQUENT_WORDS)).toArrow().sort_by("word")  # at most FREQUENT_WORDS rows
    shared = spark.sparkContext.broadcast((common["word"].to_numpy(), np.log10(common["n"].to_numpy() + 0.5) - share, often["gram"].to_numpy(), often["cost"].to_numpy()))

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", held_out.alias("held_out"), "text")
    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, cost double, words array<struct<word:long,times:long>>, grams array<struct<gram:long,times:long>>"
    scored = stored(mapped(source, _scorer(shared), schema), "scored")

    def logged(n):
        return F.log10(F.coalesce(n, F.lit(0)) + 0.5) - share

    rare = scored.select("row", F.explode("words").alias("w")).select("row", "w.word", "w.times").join(words, "word", "left")
    rare = rare.groupBy("row").agg(F.sum(F.col("times") * logged(F.col("n"))).alias("more_base"), F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"))
    missing = scored.select("row", F.explode("grams").alias("g")).select("row", "g.gram", "g.times")
    missing = missing.join(costs.drop("n"), "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("cost")).alias("more_cost"))
    rows = scored.drop("words", "grams").join(rare, "row", "left").join(missing, "row", "left")
    zero = F.lit(0)
    return rows.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero) + (1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more_base", F.lit(0.0)) + logged(F.lit(ends))).alias("base_score"),
        (F.col("cost") + F.coalesce("more_cost", F.lit(0.0))).alias("score"),
    )


def op10_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), crc_mod("doc_id", 5) == 1)
