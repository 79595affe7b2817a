"""Packing (operator 9): documents are tokenised, cut and packed by cutting-stock column generation.

A document's ids (its tokens and an end id) are cut into pieces of the full sequence length and one
shorter rest. The rests are packed: their lengths, rounded up to a multiple of a step, give a
histogram of at most ``CLASSES`` classes whatever the number of documents. The linear program over
packing patterns of this histogram is solved by the revised simplex method; an unbounded knapsack
by dynamic programming prices new patterns, until none would lower the bound by more than
``GAP``. Pattern counts are rounded down, and what is left is packed best fit decreasing. Pieces are
ranked within their class, and the rank decides pattern, copy and slot, so sequences need no
search through documents.

Rows: a null or empty text is the end id alone; repeated rows are packed each on its own; other
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.shared import mapped, ranked, span_hashes, stored, text_bytes, text_steps

LENGTH, END_ID, CLASSES, GAP = 2048, 1, 512, 1e-4
TOKENIZER = "byte_bpe_50k.json"
#: Pre-tokens whose ids a Python worker keeps; others are encoded where they occur.
HELD_TOKENS = 400_000

# Byte classes of the tokenizer's split pattern: 1 letter, 2 digit, 3 white space, 4 other; 0: not stated here.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[33:127] = 4
_KIND[[*range(65, 91), *range(97, 123), *range(0x80, 0xC0), *range(0xC3, 0xCA)]] = 1  # U+00C0 to U+027F are letters but for two signs
_KIND[48:58] = 2
_KIND[[32, 9, 10, 11, 12, 13]] = 3
_KIND[[*range(1, 9), *range(14, 28)]] = 4
_CONTRACTION = re.compile(rb"'(?:s|t|re|ve|m|ll|d)")


def split_tokens(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokens of texts whose bytes all have a class, by the pattern
    ``'s|'t|'re|'ve|'m|'ll|'d| ?letters| ?digits| ?others|space+(?!non-space)|space+``."""
    kind, n = _KIND[data], len(data)
    first = np.zeros(n + 1, dtype=bool)
    first[bounds] = True
    space = kind == 3
    begins = first[:n].copy()  # where a run of one class starts
    begins[1:] |= kind[1:] != kind[:-1]
    start = begins & ~space
    heads = np.flatnonzero(begins & space)
    if len(heads):
        runs = np.flatnonzero(begins)
        tails = np.append(runs, n)[np.searchsorted(runs, heads) + 1]
        start[heads] = True
        inner, tail = ~first[tails], tails  # a run at a text's end is one token
        start[tail[inner] - 1] = True
        joined = tail[inner][data[tail[inner] - 1] == 32]
        start[joined] = False  # a blank opens the token that follows it
    for at in np.flatnonzero((data == 39) & start).tolist():
        if m := _CONTRACTION.match(data[at : at + 3].tobytes()):
            if m.end() > 1 and not first[at + 1 : at + m.end()].any():
                start[at + 1 : at + m.end()] = False
                after = at + m.end()
                if after < n and not first[after] and not space[after]:
                    start[after] = True
    return np.flatnonzero(start)


def _merger(path: str, tokenizer: Tokenizer) -> Callable[[bytes], list[int]]:
    """Ids of one pre-token's bytes. Where the file's ids stand in the order of its merges, merging by id is the
    same thing, and a plain byte-pair merger does it without the cost of a call to the full tokenizer."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level files write as themselves
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(shown)))}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    order = [model["vocab"].get(a + b, -1) for a, b in pairs]
    if model.get("type") != "BPE" or order != sorted(order) or order[:1] != [256]:
        return lambda span: tokenizer.encode(span.decode(), add_special_tokens=False).ids
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if i < 256 + len(pairs)}
    return tiktoken.Encoding("merges", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece


class Encoder:
    """Ids of texts. Pre-tokens never influence each other, so the ids of one met before are looked up by its
    64-bit hash; a text with characters whose class is not stated above, or with an added token's string, is encoded
    as a whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # the tokenizer takes its added tokens' strings in a text for these tokens, so such texts are encoded as a whole
        added = json.loads(self.tokenizer.to_str()).get("added_tokens", [])
        self.added = [t["content"].encode() for t in added if t["content"]]
        self.merge = _merger(path, self.tokenizer)
        self.hashes, self.row = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.ids, self.begin = np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)

    def _codes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each span's row in a table of ids, the table and its bounds."""
        code, found = pd.factorize(span_hashes(data, start, end))
        at = np.searchsorted(self.hashes, found)
        known = at < len(self.hashes)
        known[known] = self.hashes[at[known]] == found[known]
        row = np.empty(len(found), dtype=np.int64)
        row[known] = self.row[at[known]]
        new = np.flatnonzero(~known)
        ids, begin = self.ids, self.begin
        if len(new):
            sample = np.empty(len(found), dtype=np.int64)
            sample[code] = np.arange(len(code))
            spans = [data[s:e].tobytes() for s, e in zip(start[sample[new]].tolist(), end[sample[new]].tolist())]
            fresh = [self.merge(x) for x in spans]
            row[new] = np.arange(len(begin) - 1, len(begin) - 1 + len(new))
            begin = np.concatenate([begin, begin[-1] + np.cumsum([len(x) for x in fresh])])
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(fresh), dtype="<u4")])
            if len(self.hashes) < HELD_TOKENS:
                order = np.argsort(found[new])
                where = np.searchsorted(self.hashes, found[new][order])
                self.hashes, self.row = np.insert(self.hashes, where, found[new][order]), np.insert(self.row, where, row[new][order])
                self.ids, self.begin = ids, begin
        return row[code], ids, begin

    def __call__(self, texts: pa.Array) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        data, bounds = text_bytes(texts)
        out = [b""] * len(texts)
        if not len(data):
            return out
        odd = _KIND[data] == 0
        sign = np.flatnonzero(data[:-1] == 0xC3)
        odd[sign[(data[sign + 1] == 0x97) | (data[sign + 1] == 0xB7)]] = True
        whole = data.tobytes() if self.added else b""
        for token in self.added:
            at = whole.find(token)
            while at >= 0:
                odd[at] = True
                at = whole.find(token, at + 1)
        counts = np.concatenate([[0], np.cumsum(odd)])
        odd_text = counts[bounds[1:]] > counts[bounds[:-1]]
        for i in np.flatnonzero(odd_text).tolist():
            out[i] = np.array(self.tokenizer.encode(texts[i].as_py(), add_special_tokens=False).ids, dtype="<u4").tobytes()
        plain = np.flatnonzero(~odd_text & (np.diff(bounds) > 0))
        if len(plain):
            if odd_text.any():
                data = np.concatenate([data[bounds[i] : bounds[i + 1]] for i in plain])
            sizes = np.concatenate([[0], np.cumsum(np.diff(bounds)[plain])])
            start = split_tokens(data, sizes)
            row, ids, begin = self._codes(data, start, np.append(start[1:], len(data)))
            size = begin[row + 1] - begin[row]
            upto = np.concatenate([[0], np.cumsum(size)])
            flat = ids[np.repeat(begin[row] - upto[:-1], size) + np.arange(upto[-1])]
            ends = upto[np.searchsorted(start, sizes)]
            for i, s, e in zip(plain.tolist(), ends[:-1].tolist(), ends[1:].tolist()):
                out[i] = flat[s:e].tobytes()
        return out


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _cutter(path: str, length: int, end_id: int, with_ids: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_steps(batch):
                row, start, size, crc, total, ids = [], [], [], [], [], []
                for i, b in enumerate(encoder(path)(texts)):
                    b += end
                    for s in range(0, len(b), 4 * length):
                        piece = b[s : s + 4 * length]
                        row.append(i), start.append(s // 4), size.append(len(piece) // 4), crc.append(zlib.crc32(piece)), total.append(len(b) // 4)
                        if with_ids:
                            ids.append(piece)
                columns = [part.column("doc_id").take(pa.array(row)), *(pa.array(x, pa.int64()) for x in (start, size, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                if with_ids:
                    columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def _best_pattern(values: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern (copies of each size) of the greatest value within ``room``."""
    use = np.flatnonzero(values > 1e-12)
    use = use[np.argsort(sizes[use])]
    size, value = sizes[use], values[use]
    best, took = np.zeros(room + 1), np.full(room + 1, -1)
    fits = np.searchsorted(size, np.arange(room + 1), side="right")
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        if fits[c]:
            x = best[c - size[: fits[c]]] + value[: fits[c]]
            k = int(x.argmax())
            if x[k] > best[c] + 1e-12:
                best[c], took[c] = x[k], k
    pattern, c = np.zeros(len(sizes), dtype=np.int64), room
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[use[took[c]]] += 1
            c -= int(size[took[c]])
    return float(best[room]), pattern


def _greedy_basis(sizes: np.ndarray, need: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A feasible basis: full patterns with the largest size left, each repeated until it uses up a size.

    A pattern holds no size used up before it, so the basis is triangular.
    """
    m, left = len(sizes), need.copy()
    columns, amount, order = np.zeros((m, m), dtype=np.int64), np.zeros(m), []
    for _ in range(m):
        open_ = np.flatnonzero(left > 0)
        if not len(open_):
            open_ = np.setdiff1d(np.arange(m), order)
        big = open_[-1]
        value = np.zeros(m)
        value[open_] = sizes[open_] * (1 + sizes[open_] / (4.0 * room * room))
        pattern = _best_pattern(value, sizes, room - int(sizes[big]))[1] if room > sizes[big] else np.zeros(m, dtype=np.int64)
        pattern[big] += 1
        use = np.flatnonzero(pattern)
        turns = left[use] / pattern[use]
        k = int(turns.argmin())
        x = max(0.0, float(turns[k]))
        left[use] = np.maximum(left[use] - x * pattern[use], 0)
        left[use[k]] = 0
        j = int(use[k])
        order.append(j)
        columns[:, j], amount[j] = pattern, x
    return columns, np.linalg.inv(columns.astype(np.float64)), amount


def patterns(demand: dict[int, int], room: int, gap: float = GAP) -> list[tuple[int, dict[int, int]]]:
    """``(copies, {size: items})`` that pack ``demand`` (items by size, each within ``room``) exactly.

    New patterns are priced at a mean of the basis' prices and the prices of the best bound so far
    (at first the sizes themselves, a bound by volume), which ends the loop much sooner.
    """
    sizes = np.array(sorted(k for k, n in demand.items() if n), dtype=np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[int(k)] for k in sizes], dtype=np.float64)
    columns, inverse, amount = _greedy_basis(sizes, need, room)
    stable = sizes / room
    bound, mean = float(need @ stable), 0.8
    while amount.sum() > bound * (1 + gap) and mean > 1e-4:
        own = inverse.sum(axis=0)
        prices = mean * stable + (1 - mean) * own
        value, pattern = _best_pattern(prices, sizes, room)
        if (found := float(need @ np.maximum(prices, 0)) / max(value, 1.0)) > bound:
            bound, stable = found, np.maximum(prices, 0) / max(value, 1.0)
        if own @ pattern <= 1 + 1e-9:
            mean /= 2
            continue
        mean = 0.8
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse -= np.outer(step, row)
        inverse[out] = row
        columns[:, out] = pattern
    whole = np.floor(amount + 1e-7).astype(np.int64)
    while (over := columns @ whole > need).any():  # rounding noise
        whole[np.flatnonzero(columns[over].any(axis=0) & (whole > 0))[0]] -= 1
    result = [(int(n), {int(s): int(k) for s, k in zip(sizes, columns[:, j]) if k}) for j, n in enumerate(whole) if n]
    left = np.rint(need).astype(np.int64) - columns @ whole
    bins: list[list[int]] = []
    free: list[int] = []
    for size, n in zip(sizes[::-1].tolist(), left[::-1].tolist()):
        for _ in range(n):
            fit = min((i for i, f in enumerate(free) if f >= size), key=free.__getitem__, default=None)
            if fit is None:
                bins.append([]), free.append(room)
                fit = len(bins) - 1
            bins[fit].append(size)
            free[fit] -= size
    return result + [(1, {s: b.count(s) for s in set(b)}) for b in bins]


def _planner(room: int):
    """The histogram (size, n) to the plan: rows (size, ranks from and below, copies in a sequence, first sequence)."""

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        demand: dict[int, int] = {}
        for batch in batches:
            demand.update(zip(batch.column("size").to_pylist(), batch.column("n").to_pylist()))
        table, base, taken = [], 0, dict.fromkeys(demand, 0)
        for copies, items in patterns(demand, room):
            for size, n in items.items():
                table.append((size, taken[size], taken[size] + copies * n, n, base))
                taken[size] += copies * n
            base += copies
        columns = list(zip(*table)) or [()] * 5
        kinds = [pa.int32(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["psize", "lo", "hi", "per", "base"])

    return plan


def pack(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, on demand,
    ``ids`` (little-endian 32-bit integers, as binary).

    ``tokenizer``: path of a tokenizer file that every executor can open.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    step = max(1, length // CLASSES)
    cut = mapped(docs.select("doc_id", "text"), _cutter(tokenizer or public_tokenizers.path(TOKENIZER), length, end_id, with_ids), schema)
    pieces = stored(cut.withColumn("size", F.ceil(F.col("length") / step).cast("int")), "pieces")
    demand = pieces.groupBy("size").agg(F.count("*").alias("n"))  # at most CLASSES rows or so: one task plans them
    plan = stored(mapped(demand.coalesce(1), _planner(-(-length // step)), "psize int, lo long, hi long, per long, base long"), "plan")
    placed = ranked(pieces.withColumn("key", F.struct("doc_id", "start", "ids_crc32", "doc_tokens")), "size", "key", buckets=256)
    # the plan's rows are bounded by the number of classes
    placed = placed.join(F.broadcast(plan), (F.col("size") == F.col("psize")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
    placed = placed.withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("per")))
    before = W.partitionBy("sequence_id").orderBy(F.desc("size"), "rank").rowsBetween(W.unboundedPreceding, -1)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).select(*names)


def op9_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
