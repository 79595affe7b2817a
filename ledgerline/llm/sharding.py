"""Sharding (operator 3): a permutation-filled lookup table gives every row's shard in constant time.

Each shard has its own permutation of the slots of a table of prime size, from an offset and a skip
taken from the MD5 of its name. Shards take turns, in order of name, and each claims the next slot
of its permutation that is still free, until no slot is free. The table's size is a parameter and
bounded by ``MOST_SLOTS``, whatever the data; it is built once and broadcast. A row's slot is its
key's MD5 modulo the table's size. When a shard joins or leaves, few slots change their shard.

Rows: a null key is placed by the row's text (null text: empty), so that many null keys do not share
a shard; equal keys share a shard; extra columns are ignored. Empty table: no rows. No shards, or a
size that is not prime or is smaller than the number of shards, is an error.
"""

from __future__ import annotations

from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS, SLOTS, MOST_SLOTS = 32, 4093, 1 << 20


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The shard (place in the sorted list of names) of each slot."""
    if not shards or slots < max(2, len(shards)) or slots > MOST_SLOTS or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("a prime number of slots, at least one for each shard, is needed")
    state = []
    for name in sorted(set(shards)):
        digest = md5(name.encode()).hexdigest()
        state.append([int(digest[:8], 16) % slots, int(digest[8:16], 16) % (slots - 1) + 1])
    table, left = [-1] * slots, slots
    while left:
        for shard, turn in enumerate(state):
            if not left:
                break
            while table[turn[0]] >= 0:
                turn[0] = (turn[0] + turn[1]) % slots
            table[turn[0]] = shard
            left -= 1
    return table


def slot_of(key: Column, slots: int) -> Column:
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long") % slots


def sharded(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard``; ``key`` is used as text, and where null, ``text``."""
    names = sorted(set(shards))
    table = df.sparkSession.createDataFrame([(i, names[s]) for i, s in enumerate(lookup_table(names, slots))], "slot long, shard string")
    place = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("null:"), F.coalesce("text", F.lit(""))) if "text" in df.columns else F.lit("null:"))
    return df.drop("slot", "shard").withColumn("slot", slot_of(place, slots)).join(F.broadcast(table), "slot")


def op3_maglev_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sharded(docs, "doc_id", [f"shard{i:02d}" for i in range(SHARDS)]).select("doc_id", "slot", "shard")


#: The same fill as a loop over turns: ``taken`` holds each slot's shard or -1.
ORACLE = f"""
WITH RECURSIVE names AS (SELECT i, format('shard{{:02d}}', i) AS shard FROM range({SHARDS}) t(i)),
prefs AS (
  SELECT i, shard, ('0x' || substr(md5(shard), 1, 8))::BIGINT % {SLOTS} AS first,
         ('0x' || substr(md5(shard), 9, 8))::BIGINT % {SLOTS - 1} + 1 AS skip FROM names),
fill(turn, taken) AS (
  SELECT 0, list_transform(range({SLOTS}), lambda x: -1)
  UNION ALL
  SELECT turn + 1, list_concat(list_concat(taken[1:pos], [turn % {SHARDS}]), taken[pos + 2:])
  FROM (SELECT turn, taken, (first + skip * (list_position(list_transform(range({SLOTS}), lambda j: taken[(first + skip * j) % {SLOTS} + 1]), -1) - 1)) % {SLOTS} AS pos
        FROM fill JOIN prefs ON prefs.i = fill.turn % {SHARDS} WHERE turn < {SLOTS})),
slots AS (SELECT unnest(range({SLOTS})) AS slot, unnest(taken) AS i FROM fill WHERE turn = {SLOTS})
SELECT d.doc_id, slots.slot, names.shard
FROM documents d
JOIN slots ON slots.slot = ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, 'null:' || coalesce(d.text, ''))), 1, 8))::BIGINT % {SLOTS}
JOIN names USING (i)
"""
