"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table: an offset and a step, both
taken from hashes of its name. The shards take turns, each claiming its first slot that is still free, until the
table is full. A key goes to the slot that its hash names and so to the shard that owns the slot. Shares of shards
differ by one slot at most, and losing a shard moves few keys beside its own.

The table has a fixed size, whatever the data; it is broadcast, so a row finds its shard by one hash probe and no
row is shuffled. No key can be hot, because placement needs no grouping.

Defined results: a null key is placed as the empty text; repeated rows stay repeated and go to one shard; an empty
table gives an empty result; columns named like an output column are replaced.
"""
from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Slots of the table; prime, and at least a hundred a shard for the default number of shards.
TABLE_SIZE = 4099
SHARDS = tuple(f"shard-{i:02d}" for i in range(40))
#: Hexadecimal digits of md5 that make a hash number (60 bits, a positive long).
HASH_DIGITS = 15


def _number(name: str) -> int:
    return int(hashlib.md5(name.encode()).hexdigest()[:HASH_DIGITS], 16)


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> list[int]:
    """The owner (index in ``shards``) of each slot. Bounded by ``size``; no data is involved."""
    if not _is_prime(size):
        raise ValueError("the size of the table must be prime, else a step may miss slots")
    if not 0 < len(shards) <= size or len(set(shards)) != len(shards):
        raise ValueError("needs distinct shards, at least one and not more than slots")
    offset = [_number(f"offset:{s}") % size for s in shards]
    step = [_number(f"step:{s}") % (size - 1) + 1 for s in shards]
    owner, tried = [-1] * size, [0] * len(shards)
    for turn in range(size):
        s = turn % len(shards)
        while owner[slot := (offset[s] + tried[s] * step[s]) % size] >= 0:
            tried[s] += 1
        owner[slot] = s
    return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, HASH_DIGITS)
    return F.pmod(F.conv(digits, 16, 10).cast("long"), F.lit(size)).cast("int")


def slots(spark, shards: Sequence[str], size: int, name: str = "shard") -> DataFrame:
    """The lookup table as rows (slot, shard): one literal, ``size`` rows."""
    owners = ",".join(shards[i] for i in lookup_table(shards, size))
    return spark.range(1).select(F.posexplode(F.split(F.lit(owners), ",")).alias("slot", name))


def place(df: DataFrame, key: Column, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE,
          name: str = "shard") -> DataFrame:
    """``df`` with ``slot`` and the shard's ``name``."""
    if any("," in s for s in shards):
        raise ValueError("a shard's name has no comma")
    table = slots(df.sparkSession, shards, size, name)
    rows = df.withColumn("slot", slot_of(key, size)).drop(name)
    return rows.join(F.broadcast(table), "slot", "left")


def write_shards(df: DataFrame, key: Column, path: str, shards: Sequence[str] = SHARDS, size: int = TABLE_SIZE) -> None:
    """Write ``df`` with a folder for each shard. Rebalancing splits a large shard over several tasks and files."""
    placed = place(df, key, shards, size).drop("slot")
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    """Shard of each document now, and after the loss of the last shard: doc_id, slot, shard, shard_after_loss."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    placed = place(docs, F.col("doc_id"))
    after = slots(spark, SHARDS[:-1], TABLE_SIZE, "shard_after_loss")
    return placed.join(F.broadcast(after), "slot", "left").select("doc_id", "slot", "shard", "shard_after_loss")


def _filled(shards: Sequence[str], size: int, name: str) -> str:
    """Recursive SQL for the fill: one row a turn, with the flags of the claimed slots."""
    number = f"('0x' || md5(%s || s)[1:{HASH_DIGITS}])::BIGINT"
    names = ", ".join(f"'{s}'" for s in shards)
    return f"""
{name}_names AS (SELECT unnest([{names}]) AS s, unnest(range({len(shards)})) AS i),
{name}_prefs AS (SELECT list({number % "'offset:'"} % {size} ORDER BY i) AS o, list({number % "'step:'"} % {size - 1} + 1 ORDER BY i) AS p,
                 list(s ORDER BY i) AS names FROM {name}_names),
{name}_turns AS (
  SELECT 0 AS turn, CAST(NULL AS BIGINT) AS slot, list_transform(range({size}), lambda x: false) AS used FROM {name}_prefs
  UNION ALL
  SELECT turn + 1, claim, list_transform(used, lambda u, k: u OR k = claim + 1)
  FROM (SELECT turn, used, list_filter(list_transform(range({size}), lambda j: (o[turn % {len(shards)} + 1] + j * p[turn % {len(shards)} + 1]) % {size}),
                                       lambda x: NOT used[x + 1])[1] AS claim
        FROM {name}_turns, {name}_prefs WHERE turn < {size})),
{name} AS (SELECT slot, names[(turn - 1) % {len(shards)} + 1] AS shard FROM {name}_turns, {name}_prefs WHERE turn > 0)"""


def oracle() -> str:
    key = f"('0x' || md5(coalesce(doc_id::VARCHAR, ''))[1:{HASH_DIGITS}])::BIGINT % {TABLE_SIZE}"
    return f"""WITH RECURSIVE {_filled(SHARDS, TABLE_SIZE, 'now')},{_filled(SHARDS[:-1], TABLE_SIZE, 'later')}
SELECT d.doc_id, CAST(d.slot AS INTEGER) AS slot, now.shard, later.shard AS shard_after_loss
FROM (SELECT doc_id, {key} AS slot FROM documents) d JOIN now USING (slot) JOIN later USING (slot)"""
