"""Cases that went wrong once: matches left out by a bound, long digit runs, strings of added tokens, clashing names."""

import random
import re
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import decontaminate, lm_score, near_dup, packing, pii, sharding, shared


def words(rng, n, kind):
    return [f"{kind}{rng.randrange(10**9)}" for _ in range(n)]


def test_windows_of_mixed_sizes_with_shared_wording(spark):
    """Items of two sizes, each size with a template passage: a document with most of an item's own words and the
    other size's template is above the threshold, though few of its shingles stand in items of the item's size."""
    rng = random.Random(1)
    template = {200: words(rng, 60, "s"), 210: words(rng, 60, "t")}
    items = [(i, 200 if i % 2 == 0 else 210) for i in range(60)]
    texts = {i: words(rng, n - 60, f"w{i}x") + template[n] for i, n in items}
    near = texts[0][:139] + template[210][:61]
    docs = [(0, " ".join(near)), (1, " ".join(texts[0])), (2, " ".join(words(rng, 300, "z")))]
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}

    def grams(t):
        return [tuple(t[i : i + 5]) for i in range(len(t) - 4)]

    held = {}
    for t in texts.values():
        for g in set(grams(t)):
            held[g] = held.get(g, 0) + 1

    def weight(g):
        return np.log(1 + len(texts) / held[g]) if g in held else np.log(1 + len(texts))

    def best(doc, item):
        own, most = grams(item), 0.0
        for s in range(max(1, len(doc) - len(item) + 1)):
            there = grams(doc[s : s + len(item)])
            both = sum(weight(g) for g in set(own) & set(there))
            most = max(most, both / (sum(weight(g) for g in set(own) | set(there))))
        return most

    want = {(d, i): best(t.split(), x) for d, t in docs for i, x in texts.items()}
    want = {k: v for k, v in want.items() if v >= 0.8}
    assert want.keys() == got.keys() and (1, 0) in want
    assert all(got[k] == pytest.approx(v) for k, v in want.items())


def test_long_digit_runs_take_linear_time():
    start = time.perf_counter()
    assert pii.spans("7" * 1_000_000) == []
    assert pii.spans("1." * 200_000)[0] == ("ip", 0, 7)
    assert time.perf_counter() - start < 5


def test_addresses_equal_the_pattern():
    base = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(5)
    for _ in range(5000):
        text = "".join(rng.choice(["1", "25", "255", "300", "007", ".", "..", " ", "a"]) for _ in range(rng.randrange(20)))
        want = [("ip", m.start(), m.end()) for m in base.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
        assert [s for s in pii.spans(text) if s[0] == "ip"] == want, text


def test_ids_of_texts_with_added_tokens():
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "plain text", "<|endoftext", "", "naïve 漢字 <|endoftext|>"]
    import pyarrow as pa

    got = packing.encoder(path)(pa.array(texts, pa.large_string()))
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in got] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_clashing_column_names(spark):
    base = "one two three four five six seven eight nine ten"
    rows = [(1, base, 5, 6, 7, 8), (2, base, 5, 6, 7, 8), (3, None, None, None, None, None), (4, "other words here", 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n int, text_key int, kept_id int, match_id int")
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(map(tuple, kept.collect())) == [rows[0], rows[2], rows[3]]
    bench = spark.createDataFrame([(9, base)], "item_id long, text string")
    clean = decontaminate.decontaminated(docs, bench)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [3, 4]
    assert shared.unused(["n", "N_"], "n", "m", "m") == ["n__", "m", "m_"]


def test_sharding_replaces_its_own_columns_only(spark):
    df = spark.createDataFrame([(1, "a", 5)], "doc_id long, shard string, other int")
    assert set(sharding.sharded(df, "doc_id", ["x", "y"]).columns) == {"doc_id", "other", "slot", "shard"}


def test_counts_merge_and_zero_weights():
    counts = lm_score._Counts()
    for keys, weight in (([5, 3, 5], 1), ([9, 3], 0), ([], 1), ([3], 1)):
        counts.add(np.array(keys, dtype=np.int64), weight)
    assert dict(zip(counts.keys.tolist(), counts.n.tolist())) == {3: 2, 5: 2, 9: 0}


def test_held_out_rows_do_not_train(spark):
    rows = [(1, "aaaa bbbb", False), (2, "aaaa cccc", True), (3, "zzzz", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, out boolean")
    got = {r.doc_id: r for r in lm_score.score(df, F.col("out")).collect()}
    assert got[1].train_tokens == 3 and (got[1].n_known, got[2].n_known, got[3].n_known) == (3, 2, 1)
