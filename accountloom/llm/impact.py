"""Exact top-k inner products from an impact-ordered index, score at a time.

Vectors are dealt to blocks of bounded size, each indexed by one task, and queries are sent
to all of them. A block's index holds, per dimension,
the postings sorted by value and cut into segments of one quantised value. For a
query, a segment's impact is the least its postings add to a score, counted from
the dimension's least contribution. Segments are taken by descending impact. What a
vector can still gain is at most the next impact for each of its dimensions not yet
seen, plus the rounding of quantised values; processing stops only when this bound
proves that few vectors can be among the best, and those are scored again exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountloom.llm.blocks import NO_ID
from accountloom.llm.common import prepare, stored

K = 10
BLOCK = 8192
# With 7 bits rounding leaves a few per cent of the rows to be scored again; with 5 most.
LEVEL_BITS = 7
ROUNDS = 8


class ImpactIndex:
    """Impact-ordered postings of the rows of an integer matrix."""

    def __init__(self, vectors: np.ndarray, level_bits: int = LEVEL_BITS):
        self.vectors = vectors
        self.n, self.dims = vectors.shape
        spread = int(vectors.max() - vectors.min()) if vectors.size else 0
        self.shift = max(0, spread.bit_length() - level_bits)
        levels = vectors >> self.shift
        order = np.argsort(levels, axis=0, kind="stable")
        self.postings = np.ascontiguousarray(order.T).astype(np.int32)
        seg_dim, seg_level, seg_start, seg_end = [], [], [], []
        for d in range(self.dims):
            values = levels[order[:, d], d]
            starts = np.flatnonzero(np.r_[self.n > 0, values[1:] != values[:-1]])
            seg_dim.append(np.full(len(starts), d))
            seg_level.append(values[starts])
            seg_start.append(starts)
            seg_end.append(np.r_[starts[1:], self.n] if len(starts) else starts)
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, np.int64)
        self.seg_dim, self.seg_level = join(seg_dim), join(seg_level)
        self.seg_start, self.seg_end = join(seg_start), join(seg_end)

    def top(self, query: np.ndarray, k: int, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) that hold at least the k best allowed rows, ties included."""
        members = self._members(query, min(k, int(allowed.sum())), allowed)
        return members, self.vectors[members] @ query

    def _members(self, query: np.ndarray, k: int, allowed: np.ndarray) -> np.ndarray:
        if k == 0:
            return np.empty(0, np.int64)
        weight = query[self.seg_dim]
        low, high = self.seg_level << self.shift, ((self.seg_level + 1) << self.shift) - 1
        least = np.where(weight >= 0, weight * low, weight * high)
        floor = np.full(self.dims, np.iinfo(np.int64).max)
        np.minimum.at(floor, self.seg_dim, least)
        impact = least - floor[self.seg_dim]
        rounding = int(np.abs(query).sum()) * ((1 << self.shift) - 1)
        order = np.argsort(-impact, kind="stable")
        order = order[weight[order] != 0]
        lengths = (self.seg_end - self.seg_start)[order]
        done = np.cumsum(lengths)
        gained = np.zeros(self.n)
        unseen = np.full(self.n, int((query != 0).sum()))
        at, total = 0, int(done[-1]) if len(done) else 0
        possible = np.flatnonzero(allowed)
        for step in range(1, ROUNDS + 1):
            to = int(np.searchsorted(done, total * step / ROUNDS, side="left")) + 1
            to = len(order) if step == ROUNDS else min(max(to, at), len(order))
            part = order[at:to]
            if len(part):
                size = lengths[at:to]
                starts = self.seg_dim[part] * self.n + self.seg_start[part]
                places = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
                ids = self.postings.ravel()[places]
                gain = np.repeat(impact[part], size)
                gained += np.bincount(ids, gain, self.n)
                unseen -= np.bincount(ids, minlength=self.n)
            at = to
            following = int(impact[order[at]]) if at < len(order) else 0
            proven = np.partition(gained[allowed], -k)[-k]
            possible = np.flatnonzero(allowed & (gained + unseen * following + rounding >= proven))
            if len(possible) <= 8 * k or at == len(order):
                break
        return possible


def quantised(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """Rows (vec_id, e): e holds floor(scale * x). Vectors null or holding null or non-finite components go."""
    x = F.col("embedding")
    finite = F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False))
    )
    ints = F.transform(x, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    return vectors.filter(x.isNotNull() & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), ints.alias("e")
    )


def _matrix(rows: list[list[int]], dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


_FOUND = {"query_id": pa.int64(), "query": pa.int64(), "vec_id": pa.int64(), "score": pa.int64()}


def _searched(k: int):
    """Blocks of vectors, each followed by the queries: a block is indexed once, queries pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, index, ids, rows = None, None, np.empty(0, np.int64), []
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for own, e, key, at in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "e", "query", "block"))):
                if at != block:
                    block, index, rows = at, None, []
                if key is None:
                    rows.append((own, e))
                    continue
                if not rows and index is None:
                    continue
                if index is None:
                    index = ImpactIndex(_matrix([r[1] for r in rows], max(len(r[1]) for r in rows)))
                    ids, rows = np.array([r[0] for r in rows], np.int64), []
                # What one vector has beyond the other's end meets zeros.
                vector = _matrix([e[: index.dims]], index.dims)[0]
                members, scores = index.top(vector, k, ids != own)
                best = np.lexsort((ids[members], -scores))[:k]
                for column, value in zip(out, ([own] * len(best), [key] * len(best), ids[members[best]], scores[best])):
                    column.extend(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _FOUND.values())], names=list(_FOUND))

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    block: int = BLOCK,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query row's k best other rows.

    vectors has vec_id and e (integers, as from quantised; scores must fit 64 bits).
    Rows with the query's own vec_id are no candidates. Equal scores rank by vec_id.
    Components missing in a shorter vector count as zero. Rows that repeat a query
    with its vector count as one query; rows that repeat a candidate each count. An
    empty table, or one without queries, gives no rows. Rows with a null id are
    candidates that rank last among equals and never queries.
    """
    spark = prepare(vectors.sparkSession)
    own_id, queried = F.coalesce("vec_id", F.lit(NO_ID)), F.col("vec_id").isNotNull() & is_query
    kept = stored(vectors.select(own_id.alias("vec_id"), "e", queried.alias("asked")), "vectors")
    asked = stored(kept.filter("asked").select("vec_id", "e").distinct(), "queries")
    blocks = max(1, -(-kept.count() // block))
    dealt = F.monotonically_increasing_id() % blocks
    # Every vector goes to one block, every query to all of them, after the block's vectors.
    rows = kept.select("vec_id", "e", F.lit(None).cast("long").alias("query"), dealt.alias("block"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    queries = asked.select("vec_id", "e", F.xxhash64("e").alias("query"), each)
    both = rows.unionByName(queries).withColumn("_is_query", F.col("query").isNotNull())
    ordered = both.repartition(blocks, "block").sortWithinPartitions("block", "_is_query").drop("_is_query")
    best = ordered.mapInArrow(_searched(k), "query_id long, query long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score")
