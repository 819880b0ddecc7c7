"""Shards by jump consistent hashing: no ring table, and a new shard only receives."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 1_024


def jump(keys, shards: int):
    """Shard of each unsigned 64-bit key (numpy array), by the jump consistent hash of
    Lamping and Veach; keys are mixed first, so that running numbers spread well."""
    import numpy as np

    if shards < 1:
        raise ValueError("at least one shard")
    key = keys.astype(np.uint64)
    key = (key ^ (key >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    key = (key ^ (key >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    key ^= key >> np.uint64(31)
    place = np.zeros(len(key), np.int64)
    ahead = np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        place[live] = ahead[live]
        k = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        key[live] = k
        draw = (k >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[live] = ((place[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        live = live[ahead[live] < shards]
    return place


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a long key; null keys share the shard of key -1."""

    @F.pandas_udf("int")
    def place(k: pd.Series) -> pd.Series:
        return pd.Series(jump(k.to_numpy("int64").view("uint64"), shards).astype("int32"))

    return place(F.coalesce(key.cast("long"), F.lit(-1).cast("long")))


def shard_rows(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
    slices: int = SLICES,
) -> DataFrame:
    """Shard, and place inside the shard, of every row.

    Law ``key``: id and shard count alone decide the shard; ``grown_shard`` is the shard
    with one more, which is either the same or the new one. Size is the text's UTF-8
    bytes plus one (null text: 1), and its CRC-32 is that of the bytes (null: of none).
    Slots run without gaps from 0 in each shard: rows are numbered inside ``slices``
    hash slices of a shard, and each slice starts where those before it end, so no task
    sorts a whole shard. Equal rows are numbered arbitrarily among themselves; null ids
    share one shard but spread over its slices by text.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    key = F.col(id_col)
    placed = docs.select(
        key.alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    placed = placed.withColumns(
        {
            "shard": shard_of(F.col("id"), shards),
            "grown_shard": shard_of(F.col("id"), shards + 1),
            "slice": F.pmod(F.xxhash64("id", "text_crc32", "size"), F.lit(slices)),
        }
    )
    inside = Window.partitionBy("shard", "slice").orderBy("text_crc32", "id", "size")
    numbered = placed.withColumn("in_slice", F.row_number().over(inside) - 1)
    # at most shards * slices rows, whatever the size of the input
    counts = placed.groupBy("shard", "slice").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = counts.select(
        "shard", "slice", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    return numbered.join(F.broadcast(offsets), ["shard", "slice"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("offset") + F.col("in_slice")).cast("long").alias("slot"),
        "grown_shard",
    )
