"""Near-duplicate detection by SimHash fingerprints, compared exactly tile by tile.

Every distinct fingerprint is put in a tile by the population counts of its four
16-bit quarters. Two fingerprints within r bits differ by at most r in the sum of
these counts' differences, so only neighbouring tiles can hold links; all other
pairs of tiles are skipped, and nothing within the radius is missed. Tiles have a
bounded size: a crowded count class is cut into several. A pair of tiles is
compared by exclusive-or and bit counts in numpy, and passes on a spanning forest
of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountloom.llm.common import prepare, stored
from accountloom.llm.components import components

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
TILE = 2048
HASHES_AT_ONCE = 65_536


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """The unsigned fingerprint; zero for a text without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    firsts, lasts = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(firsts), HASHES_AT_ONCE):
        spans = zip(firsts[at : at + HASHES_AT_ONCE], lasts[at : at + HASHES_AT_ONCE])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(firsts), bitorder="little").view("<u8")[0])


def _row() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Rows (doc_id, fp, row), one per document.

    fp is the fingerprint as a signed long, row a hash of id and text.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint_of(t.as_py(), shingle) for t in batch.column(2)]
            signed = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed), batch.column(1)], names=["doc_id", "fp", "row"]
            )

    texts = docs.select(F.col("doc_id").cast("long"), _row().alias("row"), F.col("text").cast("binary"))
    return texts.mapInArrow(run, "doc_id long, fp long, row long")


def _quarter_counts(fp: Column) -> list[Column]:
    quarters = [F.shiftrightunsigned(fp, s).bitwiseAND(F.lit(0xFFFF)) for s in (48, 32, 16, 0)]
    return [F.bit_count(q) for q in quarters]


def _steps(radius: int) -> list[int]:
    """Differences of tile keys that can hold links, each pair of tiles from one side."""
    near = range(-radius, radius + 1)
    steps = [d for d in product(near, repeat=4) if sum(map(abs, d)) <= radius and d >= (0,) * 4]
    return [sum(x * 32**i for x, i in zip(d, (3, 2, 1, 0))) for d in steps]


def links_between(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (i, j) of all pairs within the radius; rows are compared in slices."""
    found = []
    for at in range(0, len(a), 256):
        near = np.bitwise_count(a[at : at + 256, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        found.append((i + at, j))
    return np.concatenate([i for i, _ in found]), np.concatenate([j for _, j in found])


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) for nodes that are not their own smallest."""
    nodes, ends = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        np.minimum.at(new, label, new)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _tiles(distinct: DataFrame, tile: int) -> DataFrame:
    p = _quarter_counts(F.col("fp"))
    key = p[0] * 32**3 + p[1] * 32**2 + p[2] * 32 + p[3]
    keyed = distinct.select("fp", key.cast("int").alias("key"))
    # At most 17**4 classes exist, whatever the input.
    sizes = keyed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / tile).alias("pieces"))
    return (
        keyed.join(F.broadcast(sizes), "key")
        .groupBy("key", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int").alias("piece"))
        .agg(F.collect_list("fp").alias("fps"))
    )


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect just the fingerprints (column fp, distinct) linked by the radius."""
    tiles = stored(_tiles(distinct, tile), "tiles")
    steps = F.array(*[F.lit(s) for s in _steps(radius)])
    left = tiles.select(
        F.col("key").alias("left_key"),
        F.col("piece").alias("left_piece"),
        F.col("fps").alias("left_fps"),
        F.explode(F.transform(steps, lambda s: s + F.col("key"))).alias("key"),
    )
    pairs = left.join(tiles, "key").filter("left_key != key or left_piece <= piece")
    dealt = pairs.repartition("left_key", "left_piece", "key", "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, waiting = [], [], 0
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                a, b = (np.asarray(x.values).view(np.uint64) for x in (a, b))
                i, j = links_between(a, b, radius)
                u, v = a[i].view(np.int64), b[j].view(np.int64)
                u, v = forest(u[u != v], v[u != v])
                us.append(u)
                vs.append(v)
                waiting += len(u)
                if waiting > 100_000:
                    u, v = forest(np.concatenate(us), np.concatenate(vs))
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
                    us, vs, waiting = [], [], 0
        if waiting:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    return dealt.select("left_fps", "fps").mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE_WORDS, radius: int = RADIUS, tile: int = TILE
) -> DataFrame:
    """Rows (doc_id, fp, row, component_id): every document and the smallest id it is linked to.

    A null or empty text has fingerprint zero and is linked like any other. Repeated
    rows stay repeated. A null id keeps its row; it never is a component's smallest
    unless the component has no other id, which gives a null component_id. An empty
    table gives no rows; further columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    distinct = stored(
        prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints"
    )
    roots = components(links(distinct.select("fp"), radius, tile))
    rooted = distinct.join(roots.withColumnRenamed("u", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("v", "fp").alias("root")
    )
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    classes = stored(rooted.join(least, "root").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "row", "component_id")


def one_per_group(docs: DataFrame, **options) -> DataFrame:
    """The documents that are their component's smallest, with all their columns.

    Rows that repeat that id and text stay; a document without an id stays only if its whole
    component has none.
    """
    found = near_duplicates(docs, **options).filter("doc_id <=> component_id")
    kept = found.select(F.col("row").alias("_row")).distinct()
    return docs.join(kept, _row() == F.col("_row"), "left_semi")
