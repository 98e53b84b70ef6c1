"""Sharding by jump consistent hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.shared import numbered


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key: every key jumps to ever later shards until one is past the last."""
    state, at = keys.astype(np.uint64), np.zeros(len(keys), np.int64)
    going = np.arange(len(keys))
    while len(going):
        state[going] = state[going] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[going] >> np.uint64(33)).astype(np.float64) + 1
        to = ((at[going] + 1) * (2.0**31 / draw)).astype(np.int64)
        going, to = going[to < shards], to[to < shards]
        at[going] = to
    return at.astype(np.int32)


def shard_of(key: Column, shards: int) -> Column:
    """The shard of a long key; a null key counts as 0. From n to n + 1 shards, 1/(n + 1) of the keys move."""

    @F.pandas_udf("int")
    def placed(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64), shards))

    return placed(F.coalesce(key.cast("long"), F.lit(0).cast("long")))


def shard(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """One row per row of `df`: id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `key`: the id and the number of shards alone decide, so equal texts with different
    ids may part. `size` is the text's UTF-8 bytes plus 1 (null: 1), `slot` numbers a shard from 0
    without gaps, `grown_shard` is the shard with one more. Null ids count as key 0; repeated rows
    get slots of their own; an empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(F.col(id_col), shards).alias("shard"),
    )
    return numbered(rows, ["shard"], ["doc_id"], "slot").select(
        F.col("doc_id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("doc_id"), shards + 1).alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, id_col: str = "doc_id", shards: int = 16) -> None:
    """Write all columns of `df` under `path`, one folder `_shard=<n>` per shard."""
    df.withColumn("_shard", shard_of(F.col(id_col), shards)).write.partitionBy("_shard").parquet(path)
