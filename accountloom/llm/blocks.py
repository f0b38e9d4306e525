"""Documents in blocks of bounded size, the unit in which tasks exchange what they know.

A block's rows lie in one shuffle partition. Tasks that need corpus-wide facts about
what a block holds send one row per block and bucket (a range of hashes) with packed
arrays, and get one packed row back in the same order. There are never more such rows
than entries, and a key that occurs all over costs one entry per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 * 1024 * 1024
LEAST_BLOCKS = 16
LEAST_BUCKETS = 256
# Stands for a null id; larger than any other.
NO_ID = int(np.iinfo(np.int64).max)


def block_count(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BLOCKS, -(-int(size) // block_bytes))


def in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, doc_id, text as binary, rest: the other columns) dealt by block."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
        doc_id.alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
        (F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))).alias("rest"),
    ).repartition("block")


class Block:
    """A block's documents in an order that does not depend on how they arrived."""

    def __init__(self, table: pa.Table):
        ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
        known = [NO_ID if i is None else i for i in ids]
        self.order = sorted(range(len(ids)), key=lambda i: (known[i], texts[i]))
        self.ids = np.array([known[i] for i in self.order], np.int64)
        self.texts = [texts[i] for i in self.order]
        self.ends = np.cumsum([len(t) for t in self.texts], dtype=np.int64)
        self.starts = self.ends - np.array([len(t) for t in self.texts], np.int64)

    @property
    def doc_ids(self) -> pa.Array:
        return pa.array([None if i == NO_ID else i for i in self.ids.tolist()], pa.int64())


def buckets_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each hash, by its upper 24 bits; never falls as the hash grows."""
    return ((hashes >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)


def slices(bucket: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of each run in a sorted array."""
    if not len(bucket):
        return []
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    ends = np.r_[starts[1:], len(bucket)]
    return list(zip(bucket[starts].tolist(), starts.tolist(), ends.tolist()))
