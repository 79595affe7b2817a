"""Small tests of the text operators: brute force, edge rows, empty tables."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, language, lm_score, near_dup, neighbours, packing, pii, quality, sharding, shared, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, held_out boolean, words string"
WORDS = [f"w{i}" for i in range(400)]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_rows():
    base = prose(1, 120)
    near = " ".join(["changed", *base.split()[1:]])
    texts = [base, base, near, prose(2, 80), None, "", " \n\t", "one two", "one two", prose(3, 6000), "ÀÉ ñandú ×÷ 漢字", base.upper().replace("W", "w")]
    rows = [(i, t, "en" if i % 2 else None, None, None, None, None, "x") for i, t in enumerate(texts)]
    return [*rows, (None, base, "en", "s", 1, 0.5, True, None), (None, None, None, None, None, None, None, None), rows[3], rows[3]]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, int(i == 3)) for i in range(12)] + [(3, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int")


def test_near_duplicates_against_brute_force(spark, edge):
    got = near_dup.near_duplicates(edge).collect()
    rows = edge.collect()
    assert len(got) == len(rows)
    sets = [near_dup.shingle_set(r["text"]) for r in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and near_dup.similar(sets[i], sets[j], 85):
                up[max(top(i), top(j))] = min(top(i), top(j))
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[top(i)].append(r["doc_id"])
    want = Counter((r["doc_id"], len(sets[i]), min(least[top(i)]) if sets[i] and least[top(i)] else r["doc_id"]) for i, r in enumerate(rows))
    assert Counter((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got) == want
    kept = near_dup.drop_near_duplicates(edge)
    assert kept.columns == edge.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 0 in ids and 1 not in ids and 2 not in ids and ids.count(3) == 1 and 9 in ids and 5 in ids


def test_large_bucket_is_compared_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", 4)
    base = prose(9, 100).split()
    docs = spark.createDataFrame([(i, " ".join(base[: 40 + 3 * i])) for i in range(20)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs).collect()}
    sets = [near_dup.shingle_set(" ".join(base[: 40 + 3 * i])) for i in range(20)]
    assert all(near_dup.similar(sets[i], sets[i + 1], 85) for i in range(19))
    assert set(got.values()) == {0}


def test_bayes_rule_drops_little():
    for n, least in near_dup.least_matches(0.85):
        missed = sum(math.comb(n + 1, m) * 0.85**m * 0.15 ** (n + 1 - m) for m in range(least))
        assert missed < near_dup.MISS


def test_decontamination_against_brute_force(spark, edge):
    item = " ".join(prose(2, 80).split()[20:50])
    bench = spark.createDataFrame([(1, item, 0), (2, prose(77, 30), 0), (3, None, 0), (4, "", 0), (5, "one two", 0), (1, item, 0)], "item_id long, text string, words int")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontaminate.matches(edge, bench).collect()}
    assert got == {(3, 1): pytest.approx(1.0), (7, 5): pytest.approx(1.0), (8, 5): pytest.approx(1.0)}
    left = decontaminate.decontaminated(edge, bench)
    assert left.columns == edge.columns and left.count() == edge.count() - 5
    assert decontaminate.matches(edge, bench.limit(0)).count() == 0
    assert decontaminate.matches(edge.limit(0), bench).count() == 0


def best_windows(docs, items, least=0.8):
    """(doc, item): similarity and start of the best of all windows of the item's size, the first of equals."""
    shingled = lambda ws, k: [tuple(ws[i : i + k]) for i in range(len(ws) - k + 1)]
    words = {i: t.split() for i, t in items}
    held = {i: Counter(shingled(ws, min(5, len(ws)))) for i, ws in words.items()}
    df = Counter(s for c in held.values() for s in c)
    weight = lambda s: math.log(1 + len(items) / df.get(s, 1))
    out = {}
    for d, text in docs:
        doc = text.split()
        for i, ws in words.items():
            n, scored = len(ws), []
            for s in range(max(1, len(doc) - n + 1)):
                own = Counter(shingled(doc[s : s + n], min(5, n)))
                both = sum(weight(x) * min(c, held[i][x]) for x, c in own.items())
                every = sum(weight(x) * max(own[x], held[i][x]) for x in own | held[i])
                scored.append((-round(both / every, 9), s))
            if -min(scored)[0] >= least:
                out[d, i] = (-min(scored)[0], min(scored)[1])
    return out


def test_decontamination_takes_windows_off_the_alignment(spark):
    items = [(i, prose(200 + i, n)) for i, n in enumerate((60, 60, 45, 30, 52))]
    docs = [(0, f"{prose(301, 90)} {items[0][1]} {prose(302, 40)}")]
    for m in (10, 15, 20, 30):
        ws = items[0][1].split()
        docs.append((m, " ".join([prose(310 + m, 50), *ws[m:], *ws[:m], prose(320 + m, 50)])))
    for d, (i, cut) in enumerate(((1, 28), (2, 20), (4, 5)), 100):  # words put in between
        ws = items[i][1].split()
        docs.append((d, " ".join([prose(330 + d, 30), *ws[:cut], *prose(340 + d, 2).split(), *ws[cut:], prose(350 + d, 30)])))
    docs += [(200, " ".join(items[3][1].split()[2:])), (201, items[1][1] + " " + items[2][1]), (202, prose(360, 8))]
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = best_windows(docs, items)
    assert {(10, 0), (15, 0), (20, 0), (30, 0)} <= set(want)
    assert got == {key: (pytest.approx(x, abs=1e-8), s) for key, (x, s) in want.items()}


def test_fingerprints_follow_the_weighted_overlap(spark):
    rows = []  # pairs at weighted similarity 0.8: common shingles of weight 1, rare ones of weight 6 on one side each
    for i in range(150):
        for j in range(48):
            rows += [(2 * i, i * 1000 + j, 1, 1.0), (2 * i + 1, i * 1000 + j, 1, 1.0)]
        rows += [(2 * i + side, i * 1000 + 500 + side, 1, 6.0) for side in (0, 1)]
    rows += [(400, 7, 10, 1.0), (400, 8, 9, 1.0), (401, 8, 8, 1.0), (401, 7, 9, 1.0)]  # 17 of 19 occurrences in common
    prints = decontaminate._fingerprint(["g"], spark.createDataFrame(rows, "g long, shingle long, c long, weight double")).collect()
    got = {r["g"]: (r["print"], r["total"]) for r in prints}
    apart = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(got[a][0], got[b][0]))
    assert got[400][1] == 19 and got[401][1] == 17 and got[0][1] == 54
    assert apart(400, 401) <= decontaminate.RADIUS
    assert sum(apart(2 * i, 2 * i + 1) > decontaminate.RADIUS for i in range(150)) <= 4


def test_packing_is_whole_and_dense(spark, edge):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.public_tokenizers.path(packing.TOKENIZER))
    tokenizer.encode_special_tokens = True
    pieces = packing.pack(edge, length=256).collect()
    want = Counter()
    for r in edge.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        for s in range(0, len(ids), 256):
            part = np.array(ids[s : s + 256], dtype="<u4")
            want[(r["doc_id"], s, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    assert Counter((p["doc_id"], p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces) == want
    by = defaultdict(list)
    for p in pieces:
        by[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(edge.limit(0)).count() == 0


def test_cutting_stock_patterns_pack_the_demand():
    rng = np.random.default_rng(0)
    demand = {int(k): int(n) for k, n in zip(range(1, 25), rng.integers(0, 200, 24))}
    plan = packing.patterns(demand, 64)
    packed = Counter()
    for copies, items in plan:
        assert sum(s * n for s, n in items.items()) <= 64
        for s, n in items.items():
            packed[s] += copies * n
    assert packed == Counter({k: n for k, n in demand.items() if n})
    assert sum(c for c, _ in plan) <= 1.02 * sum(k * n for k, n in demand.items()) / 64 + 1


def test_pre_tokens_by_bytes_equal_the_tokenizer():
    rng = random.Random(4)
    signs = "ab é's 'll 're't d  \n\t 12 .,!_-²× ñ½‘’€漢\x1c\x85<|endoftext|>\r\n"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    encode = packing.encoder(packing.public_tokenizers.path(packing.TOKENIZER))
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encode(pa.array(texts, pa.large_string())) == want


def test_personal_data_base_spans_equal_the_patterns():
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+){3}", "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def plain(t):
        for k, p in kinds.items():
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m.group())
                if k == "email" or k == "ip" and all(int(x) <= 255 for x in m.group().split(".")) or k == "card" and 16 <= len(d) <= 19 and pii.luhn(d) or k == "phone" and 8 <= len(d) <= 15:
                    yield k, m.start(), m.end()

    rng = random.Random(5)
    for n in range(20_000):
        t = "".join(rng.choice(rng.choice(["a@.-+1 ", "0123.. -+()", "+12(). -4", "İA@b.1+"])) for _ in range(rng.randint(0, 30)))
        t += rng.choice(["", "4387513035237269", " 4387-5130-3523-7269 1", "1.2.3.4.5.6.7.8.9"]) if n % 40 == 0 else ""
        assert [s for s in pii.spans(t) if s[0] in pii.BASE_KINDS] == list(plain(t))


@pytest.mark.parametrize(
    ("text", "code"),
    [
        ("IBAN: DE89 3704 0044 0532 0130 00", "DE89 3704 0044 0532 0130 00"),
        ("IBAN DE89370400440532013000 AND MORE", "DE89370400440532013000"),
        ("iban no. GB29 NWBK 6016 1331 9268 19 THEN 5", "GB29 NWBK 6016 1331 9268 19"),
        ("IBAN is NO93 8601 1117 947.", "NO93 8601 1117 947"),
        ("IBAN DE89370400440532013000", "DE89370400440532013000"),
        ("account number: 12345678", "12345678"),
        ("account no. 12345678", "12345678"),
        ("Account 12345678, please", "12345678"),
        ("account: 12345678", "12345678"),
        ("IBAN DE88 3704 0044 0532 0130 00 AND", None),  # wrong check digits
        ("the account of 12345678 people", None),
        ("account 1234 and account holders", None),
    ],
)
def test_personal_data_account_numbers(text, code):
    assert [text[s:e] for k, s, e in pii.spans(text) if k == "secret"] == [code] * (code is not None)


def test_personal_data_masks(spark, edge):
    assert pii.mask("mail a.b@c.example.org or https://x.example/y?z=1, password=abc12345!") == "mail [EMAIL] or [URL], password=[SECRET]!"
    assert pii.mask(None) is None and pii.mask("") == ""
    out = pii.masked(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    assert pii.found(edge).count() == edge.count() and pii.found(edge.limit(0)).count() == 0


def test_sharding_is_even_stable_and_whole(spark, edge):
    names = [f"s{i}" for i in range(8)]
    table = sharding.lookup_table(names, 1009)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != 7)
    assert moved < 0.25 * 1009
    out = sharding.sharded(edge, "doc_id", names, 1009)
    assert out.count() == edge.count() and out.where("shard is null").count() == 0
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)


def test_neighbours_recall_and_edges(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((600, 16)).astype(np.float32)
    vectors[50:60] = vectors[49]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    odd = [(1000, None, 0), (1001, [0.0] * 16, 0), (1002, [float("nan")] * 16, 0), (1003, [1.0] * 3, 0), (None, [1.0] * 16, 0), (1004, [None] * 16, 0), rows[20]]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int")
    got = defaultdict(list)
    for r in neighbours.neighbours(df, F.col("vec_id") % 20 == 0, k=10, block=200, queries=16).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    wide = vectors.astype(np.float64)
    hits = 0
    twice = got.pop(20)  # two rows with this id: two queries, each a candidate of the other
    assert len(twice) == 20 and [i for i, _ in twice].count(20) == 2
    for q in sorted(got):
        s = wide @ wide[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(600), -s))[:10].tolist()
        assert len(got[q]) == 10 and all(abs(x - s[i]) < 1e-9 for i, x in got[q])
        hits += len(set(want) & {i for i, _ in got[q]})
    assert len(got) == 29 and hits >= 0.9 * 290
    assert neighbours.neighbours(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_neighbours_by_length(spark):
    """Vectors of each length are searched among themselves."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8 if i < 80 else 4).tolist()) for i in range(120)]
    got = defaultdict(list)
    for r in neighbours.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=5, block=50, queries=2).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    assert sorted(got) == [0, 20, 40, 60, 80, 100]
    for q, found in got.items():
        low, high = (0, 80) if q < 80 else (80, 120)
        s = {i: float(np.dot(rows[i][1], rows[q][1])) for i in range(low, high) if i != q}
        assert len(set(found) & set(sorted(s, key=lambda i: -s[i])[:5])) >= 4 and len(found) == 5


def test_lm_scores_equal_brute_force(spark, edge, monkeypatch):
    monkeypatch.setattr(lm_score, "FREQUENT_WORDS", 50)
    monkeypatch.setattr(lm_score, "FREQUENT_GRAMS", 200)
    order = lm_score.ORDER
    out = lm_score.score(edge, shared.crc_mod("doc_id", 5) == 1).collect()
    rows = edge.collect()
    held = [zlib.crc32(str(r["doc_id"] if r["doc_id"] is not None else "").encode()) % 5 == 1 for r in rows]
    words, trie = Counter(), [defaultdict(Counter) for _ in range(order + 1)]
    marked = [b"\xfe" * order + (r["text"] or "").encode() + b"\xff" for r in rows]
    for r, s, h in zip(rows, marked, held):
        if not h:
            words.update([*shared.words_of(r["text"]), None])
            for p in range(order, len(s)):
                for o in range(order + 1):
                    trie[o][s[p - o : p]][s[p]] += 1

    def cost(context, b):
        seen, paid = set(), 0.0
        for o in range(order, -1, -1):
            counts = trie[o].get(context[order - o :])
            if counts:
                open_ = {k: v for k, v in counts.items() if k not in seen}
                total = sum(open_.values()) + len(open_)
                if b in open_:
                    return paid + math.log10(open_[b] / total)
                paid += math.log10(len(open_) / total) if open_ else 0.0
                seen = set(counts)
        return paid - math.log10(max(256 - len(seen), 1))

    total, kinds = words.total(), len(words)
    want = sorted(
        (str(r["doc_id"]), sum(math.log10((words[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in [*shared.words_of(r["text"]), None]), sum(cost(s[p - order : p], s[p]) for p in range(order, len(s))))
        for r, s in zip(rows, marked)
    )
    got = sorted((str(r["doc_id"]), r["base_score"], r["score"]) for r in out)
    for g, w in zip(got, want, strict=True):
        assert g[0] == w[0] and g[1:] == pytest.approx(w[1:], abs=1e-6)


@pytest.mark.parametrize("name", ["quality", "toxic"])
def test_classifiers_take_edge_rows(spark, edge, labels, name):
    module = quality if name == "quality" else toxicity
    for docs in (edge, edge.limit(0)):
        for lab in (labels, labels.limit(0)):
            out = module.scored(docs, lab, shared.crc_mod("doc_id", 4) == 2).collect()
            assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)


def test_quality_and_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    lab = spark.read.parquet(f"{sf}/labels.parquet")
    for out, label, least in ((quality.op1_qda_quality(spark, sf), "quality", 0.95), (toxicity.op8_lexicon_toxicity(spark, sf), "toxic", 0.9)):
        rows = out.join(lab, "doc_id").where("held_out").collect()
        assert sum(r["predicted"] == r[label] for r in rows) >= least * len(rows)


def test_folding_meets_disguised_words():
    lexicon = toxicity.Lexicon({toxicity.folded("idiot") + "$": 4.0})
    for text in ("an IDIOT here", "an 1d10t here", "an іdiоt here", "an ïdíöt here"):
        assert len(lexicon.matched(text)[0]) == 1
    assert not lexicon.matched("an idiotic one")[0] and not lexicon.matched("no xidiot")[0]


def test_language_held_out_and_edges(spark, edge):
    sf = "/root/testdata/sf0.01"
    out = language.op6_crf_language(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.95 * len(out)
    rows = language.identified(edge.drop("held_out"), shared.crc_mod("doc_id", 3) == 1).collect()
    assert len(rows) == edge.count() and all(r["lang_pred"] == "und" for r in rows if r["doc_id"] in (4, 5, 6))
    assert language.identified(edge.limit(0), F.lit(False)).count() == 0


def learned(spark, monkeypatch, rows, most_docs):
    """Languages of the field and the texts it is fitted on by language."""
    seen = defaultdict(list)
    monkeypatch.setattr(language.Field, "fit", lambda self, texts, states: [seen[self.languages[y]].append(x) for x, y in zip(texts, states)])
    return language.learn(spark.createDataFrame(rows, "text string, lang string"), most_docs).languages, seen


def test_language_sample_takes_distinct_texts(spark, monkeypatch):
    rows = [(prose(i, 12), f"c{i}") for i in range(12) for _ in range(60)]  # copies of one text a language
    rows += [(prose(50, 12), "hot")] * 300 + [(prose(60 + i, 12), "hot") for i in range(20)]
    languages, seen = learned(spark, monkeypatch, rows, 5)
    assert languages == sorted([*(f"c{i}" for i in range(12)), "hot"])
    assert all(seen[f"c{i}"] == [prose(i, 12)] for i in range(12))
    assert len(seen["hot"]) == len(set(seen["hot"])) == 5


def test_language_learns_rare_and_long_languages(spark, monkeypatch):
    rows = [(prose(i, 12), f"l{i:03}") for i in range(130)] + [(prose(200 + i, 9000), "long") for i in range(3)]
    rows += [("12 34", "none"), ("1" * 30_000 + " word", "none")]
    languages, seen = learned(spark, monkeypatch, rows, 300)
    assert languages == sorted({lang for _, lang in rows}) and all(seen[x] for x in languages)
    assert len(seen["long"]) == 3 and all(language.MOST_CHARS <= len(x) <= language.MOST_CHARS + 3 for x in seen["long"])
    assert any("word" in x for x in seen["none"])


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(2)
    emit, move = rng.standard_normal((4, 3)), rng.standard_normal((3, 3))
    p, _ = language.marginals(emit, np.array([4]), move)
    total, own = 0.0, np.zeros((4, 3))
    for path in np.ndindex(3, 3, 3, 3):
        w = math.exp(sum(emit[i, s] for i, s in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:])))
        total += w
        for i, s in enumerate(path):
            own[i, s] += w
    assert np.allclose(p, own / total)


def test_pipeline_keeps_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = shared.stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count()
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").select("doc_id").distinct().count() == docs.count()
