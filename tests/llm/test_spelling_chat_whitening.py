"""Spelling variants, chat formatting and whitening: brute force, round trips, edge rows, empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import chat_format, spelling, whitening

# --- spelling variants ---------------------------------------------------------------------------------------


def naive_words(rows):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 3}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def naive_forms(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        form = min(near, key=lambda x: (-words[x], x), default=None)
        form = form if form and words[form] >= 2 * n else None
        out[w] = (form, n, len(near), words[form] if form else None)
    return out


def test_spelling_against_brute_force(spark):
    rng = random.Random(4)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randrange(4, 8))) for _ in range(60)]
    rows = []
    for i in range(120):
        words = [rng.choice(stems[: 1 + rng.randrange(60)]) for _ in range(60)]
        words = [w if rng.random() < 0.7 else w[:2] + rng.choice(["", "x", w[2:3] * 2, w[2:3].upper()]) + w[3:] for w in words]
        rows.append((i % 100, " ".join(words), "clash", 1))
    rows += [(None, "Straße ÀÉñ÷× STRASSE straße straße", None, None), (5, None, None, None), (6, "", None, None), (7, "漢字abcde漢字 abcde-abcde", None, None), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    words = naive_words([r[:2] for r in rows])
    exp = naive_forms(words)
    assert sum(v[0] is not None for v in exp.values()) > 20
    got = spelling.spelling_forms(spelling.word_counts(docs)).collect()
    assert len(got) == len(exp) and {r.word: (r.form, r.n, r.n_near, r.form_n) for r in got} == exp
    for r in got:
        top = r.word
        while exp[top][0]:
            top = exp[top][0]
        assert r.root == top


def test_spelling_long_chain_and_ties(spark):
    chain = ["abcdefghij"[:i] + "z" * (12 - i) for i in range(10)]  # each one edit from the next
    words = spark.createDataFrame([(w, 3 << i) for i, w in enumerate(chain)] + [("tiesa", 3), ("tiesb", 6), ("tiesc", 6)], "word string, n long")
    got = {r.word: r for r in spelling.spelling_forms(words).collect()}
    assert all(got[w].root == chain[-1] for w in chain)
    assert (got["tiesa"].form, got["tiesa"].n_near, got["tiesb"].form) == ("tiesb", 2, None)


def test_spelling_every_pair_within_one_edit_shares_a_key():
    rng = random.Random(9)
    for _ in range(300):
        a = "".join(rng.choice("abñ") for _ in range(rng.randrange(5, 12)))
        i = rng.randrange(len(a))
        b = rng.choice([a[:i] + a[i + 1 :], a[:i] + "q" + a[i:], a[:i] + rng.choice("abñq") + a[i + 1 :]])
        keys, own = spelling.signatures([a, b], {("a", 0): 1, ("b", 0): 2, ("a", 1): 3})
        assert any(k in set(keys[1]) for k in keys[0])
        first, second = (dict(zip(k.tolist(), own)) for k in keys)
        assert any(first[k] or second[k] for k in first if k in second)


def test_spelling_text_in_pieces_and_empty(spark, monkeypatch):
    text = " ".join(random.Random(2).choice(["alpha", "alphas", "Beta-Beta", "x" * 90]) for _ in range(500))
    whole = Counter(dict(spelling.words_of_text("3", text)))
    monkeypatch.setattr(spelling, "STEP", 64)
    parts = Counter()
    for w, n in spelling.words_of_text("3", text):
        parts[w] += n
    assert parts == whole
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_forms(spelling.word_counts(none)).collect() == []


# --- chat formatting -----------------------------------------------------------------------------------------

BITS = ["<", "[", "\\", "|im_end|>", "s>", "/s>", "INST]", "<<SYS>>", "é", "漢", "😀", "\n", "<s>", "a", ""]


def test_template_round_trip_and_no_smuggled_control():
    template, rng = chat_format.Template(), random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice(BITS) for _ in range(rng.randrange(12)))
        escaped = template.escape(text)
        assert template.unescape(escaped) == text
        assert not any(c in escaped for c in template.controls)
    for bad in (("<|im_start|>", "<|im_sep|>", "<|im_end|>", "end|>"), ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "aba"), ("<s>", "</s>")):
        with pytest.raises(ValueError):
            chat_format.Template(controls=bad)


def naive_digests(rows, hashes):
    template, out = chat_format.Template(), []
    marks = len(template.begin + template.middle + template.end)

    def order(r):
        return (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", hashes[r[3]])

    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=order)]
        said = "".join(f"{a}\n{b}\n" for a, b in turns)
        loss = "".join(b for a, b in turns if a == "assistant")
        chars = sum(marks + len(template.escape(a)) + len(template.escape(b)) for a, b in turns)
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=str)


@pytest.mark.parametrize("long_bytes, part_bytes", [(8 << 20, 4 << 20), (20_000, 3000)])
def test_chat_digests_against_plain_text(spark, monkeypatch, long_bytes, part_bytes):
    for name, value in (("LONG_BYTES", long_bytes), ("PART_BYTES", part_bytes), ("COPY", 1000)):
        monkeypatch.setattr(chat_format, name, value)
    rng = random.Random(3)
    ids, turns, roles = [None, 1, 2, 3, 3, 3, 3, 3], [None, *range(40)], [None, "assistant", "user", "<|im_sep|>"]
    rows = [(rng.choice(ids), rng.choice(turns), rng.choice(roles), rng.choice([None, "".join(rng.choice(BITS) for _ in range(rng.randrange(14)))]), 1) for _ in range(4000)]
    rows += rows[:3] + [(9, 0, "user", None, 1), (10, None, None, None, 2), (11, 1, "assistant", "漢<s>" * 5000, 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int").repartition(3)
    hashes = {r.text: r.h for r in df.selectExpr("text", "xxhash64(text) h").distinct().collect()}
    made = chat_format.formatted(df)
    assert sorted(map(tuple, chat_format.digests(made).collect()), key=str) == naive_digests([r[:4] for r in rows], hashes)
    parts = {r.conv_id: r["count"] for r in made.groupBy("conv_id").count().collect()}
    assert (parts[3] > 20) == (long_bytes == 20_000) and parts[9] == 1


def test_chat_formatted_text(spark):
    rows = [(1, 1, "assistant", "é</s>"), (1, 0, "user", "hi")]
    r = chat_format.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert r.formatted == "<|im_start|>user<|im_sep|>hi<|im_end|><|im_start|>assistant<|im_sep|>é<\\/s><|im_end|>"
    assert (r.part, r.n_turns, [r.formatted[s:e] for s, e in zip(r.loss_starts, r.loss_ends)]) == (0, 2, ["é<\\/s>"])
    assert chat_format.digests(chat_format.formatted(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).collect() == []


# --- whitening -----------------------------------------------------------------------------------------------


def check_whitening(vectors, rows):
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n, total = len(x), x.sum(axis=0)
    off = n * x - total
    centred = (off / n).astype(float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    z = defaultdict(dict)
    for r in rows:
        z[r.component][r.vec_id] = r.whitened
        deviation = int((off[r.vec_id] * off[r.vec_id]).sum())
        assert r.n == n and r.deviation == (deviation if deviation < 1 << 63 else None)
        assert abs(r.explained - values[r.component - 1] / values.sum()) < 1e-12 and r.identity_error < 1e-9
    for k, column in z.items():
        got, want = np.array([column[i] for i in range(n)]), centred @ axes[:, k - 1] / math.sqrt(values[k - 1])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-8
    return len(z)


@pytest.mark.parametrize("shape, scale", [((200, 12), 1), ((3, 5), 1), ((60, 4), [1e6, 1, 1e3, 30])])
def test_whitening_against_numpy(spark, shape, scale):
    vectors = (np.random.default_rng(5).normal(size=shape) * scale).tolist()
    bad = [(77, None), (78, []), (79, [None] * shape[1]), (80, [math.nan] * shape[1]), (81, [math.inf] * shape[1]), (82, [1e300] * shape[1])]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)] + bad, "vec_id long, vector array<double>")
    rows = whitening.whitened(df.repartition(3)).collect()
    k = check_whitening(vectors, rows)
    assert k == min(shape[0] - 1, shape[1]) and len(rows) == shape[0] * k


def test_whitening_multiple_root_lengths_repeats_and_empty(spark):
    axes = np.vstack([np.eye(3), -np.eye(3)]).tolist()  # one eigenvalue three times
    rows = [(i, v, "x") for i, v in enumerate(axes)] + [(None, [1.0, 2.0], None), (None, [1.0, 2.0], None), (1, [3.0, 5.0], None), (7, [4.0], None), (8, [4.0], None)]
    got = whitening.whitened(spark.createDataFrame(rows, "vec_id long, vector array<double>, component string")).collect()
    three, two = [r for r in got if r.n == 6], [r for r in got if r.n == 3]
    assert len(got) == len(three) + len(two) == 18 + 3  # equal vectors of length one have no variance
    z = np.zeros((6, 3))
    for r in three:
        z[r.vec_id, r.component - 1] = r.whitened
        assert abs(r.explained - 1 / 3) < 1e-15
    assert np.abs(z.T @ z / 6 - np.eye(3)).max() < 1e-12
    assert sorted(round(abs(r.whitened), 9) for r in two) == sorted(round(v, 9) for v in (0.5**0.5, 0.5**0.5, 2**0.5))
    assert whitening.whitened(spark.createDataFrame([], "vec_id long, vector array<float>")).collect() == []


def test_whitening_polynomial_roots_and_sums_are_exact(spark):
    rng = np.random.default_rng(8)
    for d in (1, 2, 6):
        b = rng.integers(-9, 9, size=(d, d)).astype(object)
        m = b @ b.T
        poly = whitening.characteristic_polynomial(spark, m)
        for x in range(-3, d):  # determinant by fractions-free expansion
            a = (np.eye(d, dtype=int).astype(object) * x - m).tolist()
            assert sum(c * x**k for k, c in enumerate(poly)) == exact_determinant(a)
        top = float(np.linalg.eigvalsh(m.astype(float))[-1])
        a, s = whitening.nth_root(poly, 1, int(sum(m.diagonal()))) if top else (0, 0)
        assert math.isclose(a / (1 << s), top, rel_tol=1e-9, abs_tol=1e-9)
    y = np.array([[3, -(1 << 61)], [(1 << 45) + 1, 7], [-5, 1 << 20]], dtype=np.int64)
    assert (whitening.gram(y) == y.astype(object).T @ y.astype(object)).all()


def exact_determinant(a):
    if len(a) == 1:
        return a[0][0]
    return sum((-1) ** j * a[0][j] * exact_determinant([r[:j] + r[j + 1 :] for r in a[1:]]) for j in range(len(a)))
