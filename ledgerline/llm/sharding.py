"""Permutation-filled lookup table sharding (operator 2).

Every shard has its own preference order over the slots of a prime-sized
table.  Shards take turns; each claims its first free slot, until the table is
full.  A row's key hashes to a slot, and the slot names the shard.  Slots are
shared evenly (counts differ by at most one), and removing a shard moves few
rows of the others.

Filling the table is planning over ``table_size`` numbers on the driver and
does not depend on the data.  Placement is one broadcast join on the slot,
whose table has exactly ``table_size`` rows; rows are not shuffled, so a hot
key costs nothing extra.

Defined results: a null key hashes like any other value; empty texts and
repeated rows are placed by their key alone; an empty table gives an empty
result; equal keys always share a shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
SHARDS = 256


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def preference(shard: str, table_size: int) -> tuple[int, int]:
    """Offset and step of a shard's preference order (the step never shares a factor with a prime)."""
    d = hashlib.sha256(shard.encode()).digest()
    return int.from_bytes(d[:8], "big") % table_size, int.from_bytes(d[8:16], "big") % (table_size - 1) + 1


def fill_table(shards: Sequence[str], table_size: int = TABLE_SIZE) -> list[int]:
    """Index of the owning shard for every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and differ")
    if not _is_prime(table_size) or table_size < len(shards):
        raise ValueError("the table size must be a prime no smaller than the number of shards")
    place, step = map(list, zip(*(preference(s, table_size) for s in shards)))
    owner = [-1] * table_size
    left = table_size
    while left:
        for i in range(len(shards)):
            while owner[place[i]] >= 0:
                place[i] = (place[i] + step[i]) % table_size
            owner[place[i]] = i
            left -= 1
            if not left:
                break
    return owner


def lookup(spark: SparkSession, shards: Sequence[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """``slot, shard`` (the shard's index) with ``table_size`` rows."""
    owners = ",".join(map(str, fill_table(shards, table_size)))
    numbers = F.split(F.lit(owners), ",").cast("array<int>")
    return spark.range(1).select(F.posexplode(numbers).alias("slot", "shard"))


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str], table_size: int = TABLE_SIZE) -> DataFrame:
    """``df`` with the columns ``slot`` and ``shard`` appended, by the hash of ``keys``.

    Columns of these names that ``df`` already has are replaced.
    """
    slot = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(table_size)).cast("int")
    rows = df.drop("slot", "shard").withColumn("slot", slot)
    return rows.join(F.broadcast(lookup(df.sparkSession, shards, table_size)), "slot") \
        .select(*rows.columns, "shard")


def shard_names(n: int) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every document's slot and shard, and its shard once the last shard is gone."""
    names = shard_names(SHARDS)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    now = place(docs, ["doc_id"], names)
    after = lookup(spark, names[:-1]).withColumnRenamed("shard", "shard_without_last")
    return now.join(F.broadcast(after), "slot").select("doc_id", "slot", "shard", "shard_without_last")
