"""Language identification (operator 6): a linear-chain conditional random field over words.

Each word has features of its letters alone: beginnings and ends of one to three letters, letter pairs and
triples, and lexicon entries (the commonest words of each language's training texts). States are the
languages; transitions are learned. Training sequences are pieces of labelled documents put one after
another, so that languages change within a sequence as in code-switched text. Weights are fitted by
AdaGrad on the exact likelihood gradient from forward-backward. A document's words get their
marginals by forward-backward over the whole text; the language with the largest mean marginal over
words with letters is predicted, and that mean is the score.

Every language of the training rows is a state. Training reads at most ``MOST_DOCS`` distinct texts of each, with more
than 100 languages fewer, so that all have at most ``MOST_TEXTS`` or one each: the first by a hash of the text, those
with letters first, then those up to ``MOST_CHARS``; of a longer one pieces of that length together. Prediction
reads every text whole. The weights, ``BUCKETS`` x languages, are held by the driver and each Python worker.

Rows: a null text or one without letters gets ``und`` with score 1; repeated rows and null ids each give
their row. Without labelled training rows every text is ``und`` with score 0. Ties go to the language first
in order. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.shared import crc_mod, mapped, mixed, span_hashes, stored, text_steps

MOST_DOCS, MOST_TEXTS, MOST_CHARS = 300, 30_000, 20_000
BUCKETS, EPOCHS, RATE, LENGTH, LEXICON = 1 << 16, 8, 0.3, 64, 2000
#: Words whose feature sums a Python worker keeps.
HELD_WORDS = 500_000
_LETTERS = re.compile(r"[^\W\d_]+")


def letters(word: str) -> str:
    return "".join(_LETTERS.findall(word)).lower()


def features(words: list[str], lexicon: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash buckets of the features of words (their :func:`letters`), word after word, and each word's bounds in them.

    Of ``^word$`` as UTF-8: runs of two and three bytes (with them the first and last letters), four at both
    ends, the whole word, and one bucket for each language whose lexicon (word hashes in order, languages) has it.
    """
    raw = [f"^{w}$".encode() for w in words]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    size = np.array([len(r) for r in raw], dtype=np.int64)
    end = np.cumsum(size)
    start = end - size
    word = np.repeat(np.arange(len(raw)), size)
    found, owner = [], []

    def runs_of(k: int, at: np.ndarray) -> None:
        key = np.full(len(at), k, dtype=np.uint64)
        for j in range(k):
            key = (key << np.uint64(8)) | data[at + j]
        found.append(key), owner.append(word[at])

    for k in (2, 3):
        at = np.arange(max(0, len(data) - k + 1))
        runs_of(k, at[word[at] == word[at + k - 1]])
    runs_of(4, start[size >= 4])
    runs_of(4, (end - 4)[size >= 5])
    whole = span_hashes(data, start, end) if len(data) else np.zeros(0, dtype=np.uint64)
    found.append(whole), owner.append(np.arange(len(raw)))
    if lexicon is not None:
        left, right = np.searchsorted(lexicon[0], whole), np.searchsorted(lexicon[0], whole, side="right")
        n = right - left
        entry = np.repeat(left - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        found.append(lexicon[1][entry].astype(np.uint64) + np.uint64(1)), owner.append(np.repeat(np.arange(len(raw)), n))
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    buckets = (mixed(np.concatenate(found)) % np.uint64(BUCKETS)).astype(np.int64)[order]
    return buckets, np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(raw)))])


def marginals(emit: np.ndarray, size: np.ndarray, move: np.ndarray, counted: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """State marginals of every place of sequences laid end to end and, if ``counted``, expected counts of transitions.

    ``emit``: log scores by place and state; ``size``: the sequences' lengths; ``move``: log transition
    scores. All sequences advance together, longest first.
    """
    order = np.argsort(-size, kind="stable")
    begin = np.concatenate([[0], np.cumsum(size)])[order]
    size = size[order]
    a, b = np.zeros_like(emit), np.zeros_like(emit)
    trans = np.exp(move - move.max())
    e = np.exp(emit - emit.max(axis=1, keepdims=True))
    live = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), side="right")
    for t, n in enumerate(live.tolist()):
        at = begin[:n] + t
        x = e[at] if t == 0 else e[at] * (a[at - 1] @ trans)
        a[at] = x / x.sum(axis=1, keepdims=True)
    counts = np.zeros_like(move)
    for t in range(len(live) - 1, -1, -1):
        n = int(live[t])
        at = begin[:n] + t
        ends = size[:n] == t + 1
        b[at[ends]] = 1.0
        on = at[~ends]
        if len(on):
            nxt = e[on + 1] * b[on + 1]
            back = nxt @ trans.T
            if counted:
                joint = (a[on][:, :, None] * trans[None]) * nxt[:, None, :]
                counts += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b[on] = back / back.sum(axis=1, keepdims=True)
    p = a * b
    return p / p.sum(axis=1, keepdims=True), counts


class Field:
    """Feature and transition weights; words' feature sums are kept between texts."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.weights = np.zeros((BUCKETS, len(languages)), dtype=np.float64)
        self.move = np.zeros((len(languages), len(languages)))
        self.lexicon: tuple[np.ndarray, np.ndarray] | None = None
        self._held: dict[str, int] = {}
        self._table = np.zeros((0, len(languages)))

    def __getstate__(self):
        return self.__dict__ | {"_held": {}, "_table": np.zeros((0, len(self.languages)))}

    def fit(self, texts: list[str], states: list[int], seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        words = [[x for w in t.split() if (x := letters(w))] for t in texts]
        common: dict[int, Counter] = {}
        for ws, y in zip(words, states):
            common.setdefault(y, Counter()).update(ws)
        entries = []
        for y, c in sorted(common.items()):
            raw = [f"^{w}$".encode() for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:LEXICON]]
            end = np.cumsum([len(r) for r in raw])
            hashes = span_hashes(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate([[0], end[:-1]]), end) if raw else np.zeros(0, dtype=np.uint64)
            entries += [(h, y) for h in hashes.tolist()]
        entries.sort()
        self.lexicon = np.array([h for h, _ in entries], dtype=np.uint64), np.array([y for _, y in entries], dtype=np.int64)
        pieces = []  # of 5 to 40 words, one language each
        for ws, y in zip(words, states):
            i = 0
            while i < len(ws):
                n = int(rng.integers(5, 41))
                pieces.append((ws[i : i + n], y))
                i += n
        kinds = {w: i for i, w in enumerate(dict.fromkeys(w for p, _ in pieces for w in p))}
        flat, cuts = features(list(kinds), self.lexicon)
        squares, move_squares = np.full_like(self.weights, 1e-8), np.full_like(self.move, 1e-8)
        for _ in range(EPOCHS):
            order = rng.permutation(len(pieces))
            place, state, size, held = [], [], [], 0
            for i in [*order.tolist(), -1]:
                if i >= 0:
                    place += [kinds[w] for w in pieces[i][0]]
                    state += [pieces[i][1]] * len(pieces[i][0])
                    held += len(pieces[i][0])
                if held >= LENGTH or (i < 0 and held):
                    size.append(held)
                    held = 0
                if (len(place) >= 20_000 and not held) or (i < 0 and place):
                    self._step(np.array(place), np.array(state), np.array(size), flat, cuts, squares, move_squares)
                    place, state, size = [], [], []

    def _step(self, place, state, size, flat, cuts, squares, move_squares) -> None:
        kinds, code = np.unique(place, return_inverse=True)
        sizes = cuts[kinds + 1] - cuts[kinds]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        own = flat[np.repeat(cuts[kinds] - upto[:-1], sizes) + np.arange(upto[-1])]
        scores = np.add.reduceat(self.weights[own], upto[:-1], axis=0)
        p, moves = marginals(scores[code], size, self.move)
        gold = np.zeros_like(p)
        gold[np.arange(len(state)), state] = 1
        error = gold - p
        grad = np.empty_like(self.weights)
        for y in range(p.shape[1]):
            by_kind = np.bincount(code, error[:, y], minlength=len(kinds))
            grad[:, y] = np.bincount(own, np.repeat(by_kind, sizes), minlength=BUCKETS)
        inside = np.ones(len(state), dtype=bool)
        inside[np.cumsum(size) - 1] = False
        at = np.flatnonzero(inside)
        np.add.at(moves := -moves, (state[at], state[at + 1]), 1)
        grad -= 1e-3 * self.weights
        squares += grad**2
        move_squares += moves**2
        self.weights += RATE * grad / np.sqrt(squares)
        self.move += RATE * moves / np.sqrt(move_squares)

    def rows(self, words: list[str]) -> np.ndarray:
        """Each word's row in the table of feature sums; -1 for words without letters."""
        if len(self._held) > HELD_WORDS:
            self._held, self._table = {}, self._table[:0]
        found = list(map(self._held.get, words))
        if None in found:
            new = [w for w in dict.fromkeys(w for w, i in zip(words, found) if i is None)]
            known = [(w, x) for w in new if (x := letters(w))]
            self._held.update(dict.fromkeys(new, -1))
            if known:
                flat, cuts = features([x for _, x in known], self.lexicon)
                sums = np.add.reduceat(self.weights[flat], cuts[:-1], axis=0)
                self._held.update((w, len(self._table) + i) for i, (w, _) in enumerate(known))
                self._table = np.concatenate([self._table, sums])
            found = [self._held[w] if i is None else i for w, i in zip(words, found)]
        return np.array(found, dtype=np.int64)

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        out, score = ["und"] * len(texts), [1.0] * len(texts)
        split = [t.split() for t in texts]
        row = self.rows([w for ws in split for w in ws])
        text = np.repeat(np.arange(len(texts)), [len(ws) for ws in split])[row >= 0]
        row = row[row >= 0]
        if not self.languages:
            return out, [0.0] * len(texts)
        if len(row):
            kept, size = np.unique(text, return_counts=True)
            p, _ = marginals(self._table[row].astype(np.float32), size, self.move.astype(np.float32), counted=False)
            mean = np.add.reduceat(p, np.concatenate([[0], np.cumsum(size)[:-1]]), axis=0, dtype=np.float64) / size[:, None]
            for i, m in zip(kept.tolist(), mean):
                out[i], score[i] = self.languages[int(m.argmax())], float(min(m.max(), 1.0))
        return out, score


def _bounded(text: Column) -> Column:
    """The text, or of one over ``MOST_CHARS`` as many characters in four pieces from its beginning to its end."""
    size = MOST_CHARS // 4
    pieces = [F.substr(text, (F.lit(1) + F.floor((F.length(text) - size) * i / 3)).cast("int"), F.lit(size)) for i in range(4)]
    return F.when(F.length(text) <= MOST_CHARS, text).otherwise(F.concat_ws(" ", *pieces))


def learn(docs: DataFrame, most_docs: int = MOST_DOCS) -> Field:
    """A field from the rows of ``docs(text, lang)`` with a language."""
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", F.xxhash64("text").alias("key"), "text")
    blank, long = ~F.col("text").rlike("\\p{L}"), F.length("text") > MOST_CHARS
    texts = stored(known.select("lang", "key", blank.alias("blank"), long.alias("long")).distinct(), "lang_texts")
    most = max(1, min(most_docs, MOST_TEXTS // max(1, texts.select("lang").distinct().count())))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("blank", "long", "key"))  # each task passes on its first of a language
    taken = stored(texts.withColumn("rank", rank).where(F.col("rank") <= most).select("lang", "key"), "taken")
    sample = known.join(F.broadcast(taken), ["lang", "key"]).withColumn("text", _bounded(F.col("text"))).dropDuplicates(["lang", "key"])
    rows = sorted(sample.select("lang", "text").collect())  # at most most of each language, bounded in length
    field = Field(sorted({r["lang"] for r in rows}))
    if rows:
        field.fit([r["text"] for r in rows], [field.languages.index(r["lang"]) for r in rows])
    return field


def identified(docs: DataFrame, held_out: Column, most_docs: int = MOST_DOCS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; rows that are not held out and have a ``lang`` train."""
    field = learn(docs.where(~held_out), most_docs)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_steps(batch, step=4 << 20):
                lang, score = field.predict(texts.to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return mapped(docs.select("doc_id", held_out.alias("held_out"), "text"), step, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op6_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(spark.read.parquet(f"{sf_dir}/documents.parquet"), crc_mod("doc_id", 3) == 1)
