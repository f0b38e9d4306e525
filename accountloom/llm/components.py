"""Connected components of an edge table, by alternating star contractions.

Each round writes its edges to shared storage. A hub's neighbours are reduced to
their minimum before the shuffle, and the join back to them has an exchange on
both sides, so adaptive execution can split a hub that holds a third of the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountloom.llm.common import stored

# A round writes a file for so many edges, and no fewer than the least: a file costs its writer
# time, on a local disk also processes, however little is in it.
EDGES_PER_FILE = 1_000_000
LEAST_FILES = 8


def _join_least(pairs: DataFrame, label: str, files: int) -> DataFrame:
    least = stored(pairs.groupBy("u").agg(F.min("v").alias("m")).coalesce(files), label)
    return pairs.join(least, "u")


def _large_star(edges: DataFrame, files: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = _join_least(both, "large-star", files).withColumn("m", F.least("m", "u"))
    return joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, files: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _join_least(down, "small-star", files)
    moved = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(joined.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")
    ).first()
    return row["n"], row["x"]


def components(edges: DataFrame) -> DataFrame:
    """Rows (u, v): every node of an edge but the smallest of its component, and that smallest.

    Edges are pairs (u, v) of integers; loops and repeats do no harm, and rows with a
    null are ignored. Nodes that are their own component's smallest have no row.
    """
    now = stored(edges.filter("u != v").select("u", "v").distinct(), "edges")
    before = None
    while (digest := _digest(now)) != before and digest[0]:
        before = digest
        files = max(LEAST_FILES, -(-digest[0] // EDGES_PER_FILE))
        for star in (_large_star, _small_star):
            now = stored(star(now, files).coalesce(files), "edges")
    return now
