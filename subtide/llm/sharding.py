"""Shards by jump consistent hashing: the key and the number of shards decide, no table
of the ring is kept, and a further shard only takes rows into itself."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subtide.llm.scratch import store

ROW_BYTES = 16


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each 64-bit key: jumps ahead through the bucket counts at which the
    key would move, and stays at the last one below the number of shards."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = np.ascontiguousarray(keys).astype(np.int64, copy=False).view(np.uint64).copy()
    shard = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    reached = np.zeros(len(state), dtype=np.int64)
    while len(moving):
        shard[moving] = reached
        drawn = state[moving] * np.uint64(2862933555777941757) + np.uint64(1)
        state[moving] = drawn
        step = float(1 << 31) / ((drawn >> np.uint64(33)).astype(np.float64) + 1.0)
        reached = ((shard[moving] + 1).astype(np.float64) * step).astype(np.int64)
        stays = reached < shards
        moving, reached = moving[stays], reached[stays]
    return shard.astype(np.int32)


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the UTF-8 length of the text (null: 0) plus 16 bytes; text_crc32 of a null
    text is that of the empty one, 0. A null key is a key like any other. Rows with equal
    keys, also repeated rows, share a shard and get slots of their own. No text is
    shuffled and no shard is gathered: each partition numbers its own rows of a shard,
    and the counts of the partitions before it are added. Very long texts are hashed
    whole; an empty table gives no row.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(content) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(content).alias("text_crc32"),
        F.xxhash64(F.col(key)).alias("key_hash"),
    )
    kind = dict(narrow.dtypes)["doc_id"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, taken = TaskContext.get().partitionId(), np.zeros(shards, dtype=np.int64)
        for batch in batches:
            keys = batch.column("key_hash").to_numpy(zero_copy_only=False)
            shard = jump_hash(keys, shards)
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            first = np.repeat(np.cumsum(counts) - counts, counts)
            nth = np.empty(len(shard), dtype=np.int64)
            nth[order] = np.arange(len(shard)) - first + taken[shard[order]]
            taken += counts
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "size", "text_crc32")), pa.array(shard),
                 pa.array(jump_hash(keys, shards + 1)), pa.array(np.full(len(shard), part, dtype=np.int32)), pa.array(nth)],
                names=["doc_id", "size", "text_crc32", "shard", "grown_shard", "part", "nth"],
            )

    numbered = store(
        narrow.mapInArrow(number, f"doc_id {kind}, size long, text_crc32 long, shard int, grown_shard int, part int, nth long"),
        "shards",
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        numbered.groupBy("shard", "part").agg((F.max("nth") + 1).alias("n"))
        .select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    return numbered.join(starts, ["shard", "part"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("nth")).alias("slot"), "grown_shard",
    )
