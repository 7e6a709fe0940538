"""Sharding by a permutation-filled lookup table.

Every shard has an own order of preference over the slots of a prime-sized table (an offset and a step from its
name's hash). Shards take turns claiming the next free slot of their order until the table is full. A key's slot is
its hash modulo the table size, so placement is one look-up in a broadcast table whose size is a parameter and
does not depend on the data. Removing a shard moves few keys of the others.

Defined results: a null key is hashed as the empty text; rows with equal keys share a shard; an empty table gives no
rows; all columns of the input are kept, with ``slot`` and ``shard`` replaced if it had them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SHARDS = tuple(f"shard-{i:02d}" for i in range(16))
SLOTS = 2039  # prime, over 100 slots a shard: loads differ by about a hundredth
MAX_SLOTS = 10_000_000


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def lookup_table(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> list[int]:
    """Owner of each slot; bounded work on the driver, whatever the data."""
    if not 1 <= len(shards) <= slots <= MAX_SLOTS or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime of at least the number of shards")
    at = [_hash(f"offset:{s}") % slots for s in shards]
    step = [_hash(f"step:{s}") % (slots - 1) + 1 if slots > 1 else 0 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            free -= 1
            if not free:
                break
    return owner


def assign(df: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard``: no shuffle of the data."""
    spark = df.sparkSession
    owners = spark.range(1).select(F.posexplode(F.split(F.lit(",".join(map(str, lookup_table(shards, slots)))), ",")).alias("slot", "owner"))
    names = F.split(F.lit("\x1f".join(shards)), "\x1f")
    owners = owners.select(F.col("slot").cast("long").alias("slot"), F.get(names, F.col("owner").cast("int")).alias("shard"))
    hashed = F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long")
    own = df.withColumn("shard slot", hashed % slots).join(F.broadcast(owners.select(F.col("slot").alias("shard slot"), F.col("shard").alias("shard name"))), "shard slot", "left")
    # columns of the input by these names give way, the key's value has been read by then
    return own.select(*[c for c in df.columns if c not in ("slot", "shard")], F.col("shard slot").alias("slot"), F.col("shard name").alias("shard"))


def op3_shard_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(table(spark, sf_dir, "documents").select("doc_id"), "doc_id").select("doc_id", "slot", "shard")


_TURN = f"o[turn % {len(SHARDS)} + 1]"
ORACLE = f"""
WITH RECURSIVE s AS (
  SELECT i AS k, printf('shard-%02d', i) AS name FROM range({len(SHARDS)}) r(i)),
p AS (
  SELECT list(('0x' || substr(md5('offset:' || name), 1, 8))::BIGINT % {SLOTS} ORDER BY k) AS o,
         list(('0x' || substr(md5('step:' || name), 1, 8))::BIGINT % {SLOTS - 1} + 1 ORDER BY k) AS d FROM s),
claims AS (
  SELECT 0 AS turn, [-1::BIGINT for x in range({SLOTS})] AS owner, o, d FROM p
  UNION ALL
  SELECT turn + 1, owner[:slot] || [(turn % {len(SHARDS)})::BIGINT] || owner[slot + 2:], o, d
  FROM (SELECT *, list_filter([({_TURN} + j * {_TURN.replace('o[', 'd[')}) % {SLOTS} for j in range({SLOTS})], lambda q: owner[q + 1] < 0)[1] AS slot
        FROM claims WHERE turn < {SLOTS}))
SELECT doc_id, slot, printf('shard-%02d', (SELECT owner FROM claims WHERE turn = {SLOTS})[slot + 1]) AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % {SLOTS} AS slot FROM documents)
"""
