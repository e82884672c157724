"""Shards by jump consistent hashing: no ring, and one more shard takes rows only into itself."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from grainmill.session import materialise

SLOT_ROWS = 100_000  # rows of one shard that are numbered in one task, about
_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key: jumps ahead while they land below ``shards``."""
    key, at = keys.astype(np.uint64), np.zeros(len(keys), np.int64)
    active = np.arange(len(keys))
    ahead = np.zeros(len(keys), np.int64)
    while len(active):
        at[active] = ahead[active]
        key[active] = key[active] * _STEP + np.uint64(1)
        span = float(1 << 31) / ((key[active] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[active] = ((at[active] + 1).astype(np.float64) * span).astype(np.int64)
        active = active[ahead[active] < shards]
    return at


def shard(key: Column, shards: int) -> Column:
    """The shard, 0 to ``shards`` - 1, of a long key; null keys all go where -1 goes."""
    if not 0 < shards < 2**31:
        raise ValueError("the number of shards must be between 1 and 2**31 - 1")

    @F.arrow_udf("int")
    def jump(keys: pa.Array) -> pa.Array:
        return pa.array(jump_hash(keys.to_numpy(zero_copy_only=False).view(np.uint64), shards).astype(np.int32))

    return jump(F.coalesce(key.cast("long"), F.lit(-1).cast("long")))


def with_slots(rows: DataFrame, key: str, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """``rows`` (stored, columns shard, ``key`` and ``uid``) with ``slot``: 0, 1, ... in each shard, by key.

    Rows are dealt by ranges of (shard, key, uid) and stored, so a key that very many rows share is
    cut by ``uid``. They are numbered within a range, and each range begins where those before it in its
    shard end: a sum over one row per range and shard. No task gets many more than ``slot_rows`` rows. Null
    keys come first.
    """
    parts = max(1, math.ceil(rows.count() / slot_rows))
    ranged = rows.repartitionByRange(parts, "shard", key, "uid").withColumn("part", F.spark_partition_id())
    ranged = materialise(ranged, "shard-ranges")
    sizes = ranged.groupBy("shard", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    own = F.row_number().over(Window.partitionBy("shard", "part").orderBy(key, "uid")) - 1
    numbered = ranged.withColumn("own", own).join(first, ["shard", "part"])
    return numbered.withColumn("slot", F.col("first") + F.col("own"))


def assign(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slot_rows: int = SLOT_ROWS
) -> DataFrame:
    """One row per document: ``key``, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text plus 16; null texts have none, and the checksum of no bytes.
    law is ``key``: the key and the number of shards decide alone, so a rerun or any other order
    of the rows gives the same shards, and rows with equal keys stay together. grown_shard is the
    shard among one more. slot numbers each shard's rows from 0 in order of the key, equal keys
    in any order. Whole numbers are hashed as they are, keys of other types by their 64-bit hash. Null keys
    form one key. Other columns are ignored; no rows give no rows.
    """
    whole = isinstance(docs.schema[key].dataType, T.IntegralType)
    number = F.col("key").cast("long") if whole else F.when(F.col("key").isNotNull(), F.xxhash64("key"))
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    octets = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        F.col("key").cast("long") if whole else "key",
        (F.octet_length(octets) + 16).cast("long").alias("size"),
        F.crc32(octets).alias("text_crc32"),
        shard(number, shards).alias("shard"),
        shard(number, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("uid"),
    )
    placed = with_slots(materialise(rows, "shards"), "key", slot_rows)
    return placed.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("slot").cast("long"),
        "grown_shard",
    )
