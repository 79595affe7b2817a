"""Benchmark decontamination (operator 4): SimHash of item-sized windows, multi-index Hamming blocks, exact check.

DataFrame functions only. A document window that shares no 5-word shingle with any benchmark item has
similarity 0 to all of them. Of windows of one size the best ends with a shingle that some item has, or starts
the document: moving a window off an unknown shingle at its edge loses nothing shared, and no shingle weighs more
than an unknown one. So every such shingle gives, for each item size n met in the document, the windows of n words that
end and that begin with it (moved into the document at its ends); those whose shingles of items of that
size weigh too little, against all their shingles, to reach the similarity are left out: an exact bound. Each window gets a 128-bit SimHash of its
shingles, each weighing the root of its weight: so at similarity J the cosine is 2J / (1 + J) or more.
Sixteen blocks of 8 bits index the fingerprints of the items of that size, each block with all values
one bit away, so every fingerprint within ``RADIUS`` = 31 bits is found: 31 differing bits leave one
of 16 blocks with at most one. Candidates within the radius are verified by the exact similarity:
the sum over shingles of weight times the smaller count, divided by that of the larger count. A
shingle's weight falls with the number of items that have it.

Rows: null, empty and blank texts match nothing; an item of fewer than five words is one shingle of
all its words; blank items match nothing; items with equal text are matched each on its own. Repeated
documents and null ids match as any; a pair is given once per distinct (id, text). Extra columns are
ignored. An empty documents or benchmark table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerline.llm.shared import small_side, stored, unused

SIZE, SIMILARITY, BITS, BLOCK, RADIUS = 5, 0.8, 128, 8, 31
#: Rows up to which the benchmark's shingles, or the windows, are broadcast; beyond, the joins shuffle.
BROADCAST_ROWS = 500_000


def _words(text: Column) -> Column:
    """Words of lower-cased text, split at ASCII white space."""
    return F.filter(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _shingles(words: Column, size: int) -> Column:
    """64-bit hashes of the shingles of ``size`` words by place."""
    places = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(size)]))


def _fingerprint(group: list[str], rows: DataFrame) -> DataFrame:
    """128-bit SimHash, as 16 numbers of 8 bits, of the ``shingle`` rows of each group with their number ``c`` and ``weight``.

    Each occurrence adds or takes away the root of its weight: the angle follows the squares, so the weighted overlap.
    The first, second... occurrences are features of their own, so common is the smaller count. Roots are
    summed as whole numbers, so equal groups get equal fingerprints in any order."""
    rows = rows.withColumn("j", F.explode(F.sequence(F.lit(1), F.col("c").cast("int"))))
    halves = [F.xxhash64(F.lit(seed), "shingle", "j") for seed in (1, 2)]
    rows = rows.withColumns({"h0": halves[0], "h1": halves[1], "root": F.round(F.sqrt("weight") * (1 << 20)).cast("long")})
    sums = [F.sum(F.when(F.col(f"h{b // 64}").bitwiseAND(F.shiftleft(F.lit(1).cast("long"), b % 64)) != 0, F.col("root")).otherwise(-F.col("root"))).alias(f"s{b}") for b in range(BITS)]
    summed = rows.groupBy(*group).agg(*sums, F.sum("weight").alias("total"))

    def block(k: int) -> Column:
        return sum((F.when(F.col(f"s{k * BLOCK + b}") > 0, 1 << b).otherwise(0) for b in range(1, BLOCK)), F.when(F.col(f"s{k * BLOCK}") > 0, 1).otherwise(0))

    return summed.select(*group, "total", F.array(*[block(k) for k in range(BITS // BLOCK)]).alias("print"))


def _starts(hits: DataFrame, k: int, similarity: float, unseen: Column) -> DataFrame:
    """Windows that begin or end with one of ``hits`` and can reach ``similarity``: the weights of their shingles that
    stand in items of their size (all that can be shared) are at least that part of the weights of all their shingles."""
    by_doc = hits.groupBy("doc_id", "tkey", "size").agg(F.collect_set(F.struct("p", "sizes", "weight")).alias("hits"))
    by_size = by_doc.withColumn("n", F.explode(F.array_distinct(F.flatten("hits.sizes"))))
    rows = by_size.select("doc_id", "tkey", "size", "n", F.inline("hits"))
    length = F.least("n", "size") - k + 1  # of a window, in shingles
    own = F.when(F.array_contains("sizes", F.col("n")), F.col("weight")).otherwise(0.0)
    # an unknown shingle weighs ``unseen``; what a window lacks of its length times that is the shortfall of its hits
    bound = own + similarity * (unseen - F.col("weight"))
    rows = rows.withColumns({"bound": bound, "place": F.col("p") / length})
    around = W.partitionBy("doc_id", "tkey", "size", "n").orderBy("place")  # a window's length is 1
    rows = rows.withColumns({"ending": F.sum("bound").over(around.rangeBetween(-1, 0)), "beginning": F.sum("bound").over(around.rangeBetween(0, 1))})
    last = F.greatest(F.lit(0), F.col("size") - F.col("n"))
    least = similarity * unseen * length * (1 - 1e-6)
    starts = F.array(F.when(F.col("ending") >= least, F.greatest(F.lit(0), F.col("p") - F.col("n") + k)), F.when(F.col("beginning") >= least, F.least("p", last)))
    return rows.select("doc_id", "tkey", F.explode(F.array_compact(starts)).alias("start"), "n", F.lit(k).alias("k"))


def _distance(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, tkey, item_id, start, n_words, similarity, distance``: the best window of each document and item
    with at least ``similarity``, the first of equally good ones; ``tkey`` is the text's ``xxhash64``, ``start`` counts words from 0."""
    items = benchmark.select("item_id", _words(F.col("text")).alias("words")).where("size(words) > 0")
    items = items.withColumn("item", F.xxhash64(F.col("item_id").cast("string"), "words")).withColumn("n", F.size("words")).withColumn("k", F.least("n", F.lit(SIZE)))
    items = stored(items.dropDuplicates(["item"]), "items")
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most five values
    parts = [items.where(F.col("k") == k).select("item", "n", "k", F.posexplode(_shingles(F.col("words"), k)).alias("o", "shingle")) for k in sizes]
    if not parts:
        parts = [items.select("item", "n", "k", F.lit(0).alias("o"), F.lit(0).cast("long").alias("shingle")).limit(0)]
    places = parts[0]
    for p in parts[1:]:
        places = places.union(p)
    places = stored(places, "places")
    n_items = items.count()
    rarity = places.groupBy("shingle").agg(F.log(1 + F.lit(n_items) / F.count_distinct("item")).alias("weight"))
    rarity = stored(rarity, "weights")
    weights = small_side(rarity, BROADCAST_ROWS)
    unseen = F.log(F.lit(1.0 + n_items))

    source = docs.select("doc_id", "text").withColumn("tkey", F.xxhash64("text"))
    worded = source.select("doc_id", "tkey", _words(F.col("text")).alias("words"))
    seen = places.groupBy("k", "shingle").agg(F.sort_array(F.collect_set("n")).alias("sizes"))
    seen = stored(seen.join(rarity, "shingle"), "seen")
    found = None
    for k in sizes or [SIZE]:
        hits = worded.select("doc_id", "tkey", F.size("words").alias("size"), F.posexplode(_shingles(F.col("words"), k)).alias("p", "shingle"))
        hits = hits.join(small_side(seen.where(F.col("k") == k).drop("k"), BROADCAST_ROWS), "shingle")
        hits = _starts(hits, k, similarity, unseen)
        found = hits if found is None else found.union(hits)
    windows = stored(found.distinct(), "windows")

    keys = windows.toDF("w_id", "w_key", "start", "n", "k")
    own = source.doc_id.eqNullSafe(F.col("w_id")) & (source.tkey == F.col("w_key"))
    cut = source.join(small_side(keys, BROADCAST_ROWS), own).dropDuplicates(["doc_id", "tkey", "start", "n"])
    cut = cut.select("doc_id", "tkey", "start", "n", "k", F.slice(_words(F.col("text")), F.col("start") + 1, F.col("n")).alias("words"))
    cut = stored(cut.withColumn("window", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "tkey", "start", "n")), "cut")
    exploded = None
    for k in sizes or [SIZE]:
        part = cut.where(F.col("k") == k).select("window", "n", F.explode(_shingles(F.col("words"), k)).alias("shingle"))
        exploded = part if exploded is None else exploded.union(part)
    counts = exploded.groupBy("window", "n", "shingle").agg(F.count("*").alias("c"))
    counts = stored(counts.join(weights, "shingle", "left").withColumn("weight", F.coalesce("weight", unseen)), "counts")
    window_prints = stored(_fingerprint(["window", "n"], counts), "window_prints")
    item_counts = stored(places.groupBy("item", "n", "shingle").agg(F.count("*").alias("d")), "item_counts")
    item_prints = stored(_fingerprint(["item", "n"], item_counts.withColumnRenamed("d", "c").join(weights, "shingle")), "item_prints")

    near = F.expr("concat(array(value), transform(sequence(0, 7), b -> value ^ shiftleft(1, b)))")
    index = item_prints.select("item", "n", F.col("print").alias("item_print"), F.col("total").alias("item_total"), F.posexplode("print").alias("block", "value"))
    index = index.withColumn("value", F.explode(near))
    probes = window_prints.select("window", "n", "print", "total", F.posexplode("print").alias("block", "value"))
    candidates = probes.join(small_side(stored(index, "index"), BROADCAST_ROWS), ["n", "block", "value"])
    candidates = candidates.withColumn("distance", _distance("print", "item_print")).where(F.col("distance") <= RADIUS)
    candidates = stored(candidates.select("window", "item", "distance", "total", "item_total").distinct(), "candidates")

    shared = candidates.join(counts.drop("n"), "window").join(item_counts.drop("n"), ["item", "shingle"])
    shared = shared.groupBy("window", "item", "distance", "total", "item_total").agg(F.sum(F.col("weight") * F.least("c", "d")).alias("both"))
    verified = shared.withColumn("similarity", F.col("both") / (F.col("total") + F.col("item_total") - F.col("both"))).where(F.col("similarity") >= similarity - 1e-9)
    named = verified.join(cut.drop("words", "k"), "window").join(items.select("item", "item_id"), "item")
    rank = -F.round("similarity", 9)  # sums of equal windows can differ in their last bits
    best = named.groupBy("doc_id", "tkey", "item", "item_id", F.col("n").alias("n_words")).agg(F.min(F.struct(rank, "start", "similarity", "distance")).alias("b"))
    return best.select("doc_id", "tkey", "item_id", "b.start", "n_words", "b.similarity", "b.distance")


def decontaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows of ``docs`` that match no benchmark item."""
    key, m_id, m_key = unused(docs.columns, "text_key", "match_id", "match_key")
    leaks = matches(docs, benchmark, similarity).select(F.col("doc_id").alias(m_id), F.col("tkey").alias(m_key)).distinct()
    keyed = docs.withColumn(key, F.xxhash64("text"))
    leaks = small_side(stored(leaks, "leaks"), BROADCAST_ROWS)
    return keyed.join(leaks, F.col("doc_id").eqNullSafe(F.col(m_id)) & (F.col(key) == F.col(m_key)), "left_anti").drop(key)


def op4_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "item_id", "start", "n_words", F.round("similarity", 6).alias("similarity"))
