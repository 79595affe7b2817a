"""Toxicity (operator 8): a weighted lexicon, matched by an Aho-Corasick automaton on folded text.

Folding lowers, strips accents, maps look-alike letters of other scripts and digits and signs used as
letters to one form, and lets i, l, 1 and ! fall together; lexicon and text are folded alike. The lexicon
is learned: words and word beginnings of four to six letters whose documents are labelled toxic far more
often than others (by the likelihood ratio), weighted by log odds. A match counts at the start of a
word, whole words only to their end; of several matches in a word the heaviest counts. Words in an
exception phrase (given, or learned from clean documents) do not count. The sum of weights per word of
text goes through a logistic curve fitted on the same rows.

Learning uses at most about ``MOST_ROWS`` labelled rows, picked by a hash of their id; their texts are read whole.

Rows: null and empty texts score as texts without matches; repeated rows and null ids each give their row.
Ids with contradicting labels do not train. Without toxic training rows only ``SEEDS`` count. Extra columns
are ignored. Empty table: no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import crc_mod, mapped, stored

MOST_ROWS, THRESHOLD = 30_000, 0.3
#: Least likelihood ratio of a lexicon entry, and the most entries kept (the heaviest).
EVIDENCE, MOST_ENTRIES = 45.0, 20_000
SEEDS = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic", "disgusting")
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown fish")

# Letters that look alike, and signs used as letters.
_ALIKE = dict(zip("абвгеёзикмнорстухіјѕһԁԛԝαβεηικνορτυχ", "abbreeзukmhopctyxijshdqwabenikvoptux")) | {"з": "3"}
_SIGNS = dict(zip("013457@$!|8", "oieastasiib"))
_FOLD: dict[int, str] = {}
for _c in range(0x180):
    _base = unicodedata.normalize("NFKD", chr(_c)).encode("ascii", "ignore").decode().lower()
    if _c >= 0x80 and _base.isalpha():
        _FOLD[_c] = _base
_FOLD |= {c: chr(c + 32) for c in range(65, 91)} | {ord(k): v for k, v in _ALIKE.items()} | {ord(k.upper()): v for k, v in _ALIKE.items() if len(k.upper()) == 1}
_FOLD |= {ord("ß"): "s", ord("ø"): "o", ord("Ø"): "o", ord("ł"): "l", ord("Ł"): "l", ord("æ"): "a", ord("œ"): "o"} | {ord(k): v for k, v in _SIGNS.items()}
_FOLD |= {c: "" for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370))}
_FOLD |= {c: chr(c - 0xFEE0).lower() for c in (*range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B))}
_FOLD = {k: v.replace("l", "i") for k, v in _FOLD.items()} | {ord("l"): "i", ord("L"): "i"}
_WORD = re.compile(r"[^\W\d_]+")


def folded(text: str) -> str:
    return text.translate(_FOLD)


def _entries(words: set[str]) -> set[str]:
    """Words (with an end mark) and their beginnings."""
    out = set()
    for w in words:
        if len(w) >= 3:
            out.add(w + "$")
            out.update(w[:k] for k in (4, 5, 6) if k < len(w))
    return out


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entry, documents of class 1, documents of class 0)."""
    held: dict[str, list[int]] = {}

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(held, pa.string()), *(pa.array([v[k] for v in held.values()], pa.int64()) for k in (0, 1))], names=["entry", "ones", "zeros"])

    for batch in batches:
        for text, y in zip(batch.column("text"), batch.column("y").to_pylist()):
            for e in _entries(set(_WORD.findall(folded(text.as_py() or "")))):
                held.setdefault(e, [0, 0])[1 - y] += 1
            if len(held) > 400_000:
                yield flush()
                held.clear()
    yield flush()


class Lexicon:
    """Weights by entry; exception phrases; the logistic curve."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.weights, self.exceptions, self.curve = weights, tuple(folded(e) for e in exceptions), (-4.0, 3.0)
        self._automaton = None

    def __getstate__(self):
        return self.__dict__ | {"_automaton": None}

    def automaton(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            a = ahocorasick.Automaton()
            for e, w in self.weights.items():
                whole = e.endswith("$")
                body = e.rstrip("$")
                old = a.get(body, (len(body), 0.0, 0.0, ""))
                a.add_word(body, (len(body), max(old[1], w) if whole else old[1], old[2] if whole else max(old[2], w), ""))
            for e in self.exceptions:
                old = a.get(e, (len(e), 0.0, 0.0, ""))
                a.add_word(e, (*old[:3], e))
            if not len(a):
                a.add_word("\0", (1, 0.0, 0.0, ""))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def matched(self, text: str) -> tuple[list[tuple[int, int, float]], int]:
        """Matches (start and end in the folded text, weight), heaviest of each word, and the number of words."""
        low = folded(text)
        best: dict[int, tuple[int, float]] = {}
        free: list[tuple[int, int]] = []
        for last, (size, whole, begin, phrase) in self.automaton().iter(low):
            start, end = last - size + 1, last + 1
            if start and low[start - 1].isalpha():
                continue
            closed = end == len(low) or not low[end].isalpha()
            if phrase and closed:
                free.append((start, end))
            w = max(whole if closed else 0.0, begin)
            if w > best.get(start, (0, 0.0))[1]:
                best[start] = (end, w)
        return [(s, e, w) for s, (e, w) in sorted(best.items()) if not any(a <= s < b for a, b in free)], len(low.split())

    def density(self, text: str | None) -> float:
        found, words = self.matched(text or "")
        return 100 * sum(w for *_, w in found) / max(words, 20)

    def score(self, density):
        a, b = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * np.log1p(density), -50, 50)))


def learn(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", most_rows: int = MOST_ROWS) -> Lexicon:
    clear = labels.where(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("z")).where("y = z").select("doc_id", "y")
    clear = clear.where(~held_out)
    n = clear.count()
    if n > most_rows:
        clear = clear.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * most_rows / n))
    train = docs.select("doc_id", "text").join(clear, "doc_id").select("text", "y")
    train = stored(train, "train")
    sizes = dict(train.groupBy("y").count().collect())
    ones, zeros = sizes.get(1, 0), sizes.get(0, 0)
    weights = {folded(s) + "$": 3.0 for s in SEEDS}
    if not ones or not zeros:
        return Lexicon(weights)
    gathered = mapped(train, _gather, "entry string, ones long, zeros long").groupBy("entry").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    odds = F.log((F.col("ones") + 0.5) / (ones + 1.0)) - F.log((F.col("zeros") + 0.5) / (zeros + 1.0))
    p = ones / (ones + zeros)
    both = F.col("ones") + F.col("zeros")

    def part(k: str, q: float) -> Column:
        return F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / (both * q))).otherwise(0.0)

    strong = gathered.where((F.col("ones") >= 5) & (odds > 2.0)).withColumn("g", 2 * (part("ones", p) + part("zeros", 1 - p))).where(F.col("g") >= EVIDENCE)
    rows = strong.select("entry", odds.alias("w"), "g").orderBy(F.desc("g"), "entry").limit(MOST_ENTRIES).collect()
    weights |= {r["entry"]: float(min(r["w"], 8.0)) for r in rows}
    lexicon = Lexicon(weights)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Densities, and phrases of a matched word and the next one."""
        for batch in batches:
            density, phrases = [], []
            for text in batch.column("text"):
                t = text.as_py() or ""
                density.append(lexicon.density(t))
                low = folded(t)
                phrases.append(list({m.group() for s, *_ in lexicon.matched(t)[0] if (m := re.compile(r"[^\W\d_]+ [^\W\d_]+").match(low, s))}))
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(density, pa.float64()), pa.array(phrases, pa.list_(pa.string()))], names=["y", "density", "phrases"])

    seen = stored(mapped(train, contexts, "y int, density double, phrases array<string>"), "densities")
    phrases = seen.select("y", F.explode("phrases").alias("phrase")).groupBy("phrase").agg(F.sum("y").alias("ones"), F.sum(1 - F.col("y")).alias("zeros"))
    benign = [r["phrase"] for r in phrases.where((F.col("zeros") >= 3) & (F.col("zeros") > 3 * F.col("ones"))).orderBy(F.desc("zeros"), "phrase").limit(MOST_ENTRIES).collect()]
    lexicon = Lexicon(weights, (*EXCEPTIONS, *benign))
    rows = seen.select("y", F.round(F.log1p("density"), 2).alias("x")).groupBy("x", "y").count().collect()  # hundredths of a bounded range
    x, y, c = (np.array([r[k] for r in rows], dtype=float) for k in ("x", "y", "count"))
    a, b = -2.0, 1.0
    for _ in range(50):  # Newton steps with a small penalty, so that separable classes end too
        q = 1 / (1 + np.exp(-(a + b * x)))
        g = np.array([(c * (y - q)).sum() - 0.01 * a, (c * (y - q) * x).sum() - 0.01 * b])
        h = np.array([[(c * q * (1 - q)).sum() + 0.01, (c * q * (1 - q) * x).sum()], [(c * q * (1 - q) * x).sum(), (c * q * (1 - q) * x * x).sum() + 0.01]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    lexicon.curve = (float(a), float(b))
    return lexicon


def scored(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", most_rows: int = MOST_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_matches`` for each row of ``docs``."""
    lexicon = learn(docs, labels, held_out, label, most_rows)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            density, n = [], []
            for text in batch.column("text"):
                found, words = lexicon.matched(text.as_py() or "")
                density.append(100 * sum(w for *_, w in found) / max(words, 20)), n.append(len(found))
            s = lexicon.score(np.array(density))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array(n, pa.int64())],
                names=["doc_id", "held_out", "score", "predicted", "n_matches"],
            )

    source = docs.select("doc_id", held_out.alias("held_out"), "text")
    return mapped(source, step, f"doc_id {kind}, held_out boolean, score double, predicted int, n_matches long")


def op8_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"), crc_mod("doc_id", 4) == 2)
