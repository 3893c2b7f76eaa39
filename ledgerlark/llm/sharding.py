"""Shard placement by a permutation-filled lookup table.

Every shard has its own preference order of the table's slots (an offset and a skip from its name, a permutation because
the size is prime). The shards take turns; in its turn a shard claims the first slot of its order that is still free.
A row's key hashes to a slot, and the slot names the shard. Shards own equal shares to within one slot, and a shard that
joins or leaves moves little more than its own share of the rows.

The table has ``size`` rows whatever the data: it is configuration, filled once from the shard names. Placement is a join
with that table, broadcast because its size is fixed and checked here; no row is shuffled and no key can be hot.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: At least a hundred slots per shard keep the shares within one per cent; more than this is not broadcast.
LARGEST_TABLE = 1 << 20


def _hash(text: str) -> int:
    return int(md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: Sequence[str], size: int) -> list[int]:
    """The index of the shard that owns each slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("name at least one shard, each once")
    if size < len(shards) or size > LARGEST_TABLE or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError(f"the table's size is a prime from the number of shards to {LARGEST_TABLE}")
    at = [_hash(name + "/offset") % size for name in shards]
    skip = [_hash(name + "/skip") % (size - 1) + 1 if size > 2 else 1 for name in shards]
    owner = [-1] * size
    for turn in range(size):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + skip[i]) % size
        owner[at[i]] = i
    return owner


def shard_table(spark: SparkSession, shards: Sequence[str], size: int) -> DataFrame:
    """One row per slot: ``slot``, ``shard`` (index) and ``shard_name``."""
    owners = F.split(F.lit(",".join(map(str, fill(shards, size)))), ",")
    names = F.split(F.lit("\n".join(shards)), "\n")
    table = spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
    shard = F.col("owner").cast("int")
    return table.select("slot", shard.alias("shard"), F.get(names, shard).alias("shard_name"))


def slot_of(key: Column, size: int) -> Column:
    """The slot of a key: 60 bits of its MD5."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("bigint") % size


def place(df: DataFrame, key: str | Sequence[str], shards: Sequence[str], size: int) -> DataFrame:
    """``df`` with ``slot``, ``shard`` and ``shard_name``.

    A row without any key is placed by all its columns, so that many of them do not meet in one shard. Equal keys share a
    shard; repeated rows do too. Columns of ``df`` named like the added ones are replaced. An empty ``df`` stays empty.
    """
    keys = [key] if isinstance(key, str) else list(key)
    simple = [c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    text = F.concat_ws("\x1f", *[F.coalesce(df[c].cast("string"), F.lit("\x00")) for c in keys])
    if len(keys) == 1:
        text = df[keys[0]].cast("string")
    missing = F.coalesce(*[df[c].cast("string") for c in keys]).isNull()
    text = F.when(missing, F.to_json(F.struct(*[df[c] for c in simple]))).otherwise(text)
    rows = df.withColumn("slot", slot_of(text, size).cast("int")).drop("shard", "shard_name")
    return rows.join(F.broadcast(shard_table(df.sparkSession, shards, size)), "slot", "left").select(
        *[rows[c] for c in rows.columns], "shard", "shard_name")


def write_shards(df: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """Placed rows written below ``shard=<index>``; each shard's rows are dealt over ``files_per_shard`` tasks."""
    deal = F.pmod(F.xxhash64(*[F.col(c) for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]), F.lit(files_per_shard))
    df.repartition(F.col("shard"), deal).write.partitionBy("shard").mode("overwrite").parquet(path)


def shares(placed: DataFrame) -> DataFrame:
    """Rows and slots in use per shard."""
    return placed.groupBy("shard", "shard_name").agg(F.count("*").alias("rows"), F.count_distinct("slot").alias("slots"))
