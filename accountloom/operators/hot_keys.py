"""Which keys of a frame have more rows than one task should take.

Sizes in bytes do not tell: sorted and compressed, millions of rows of one key take a few
kilobytes. So rows are counted, each step only where the one before leaves a doubt. The
files' footers bound the rows of a plan; a plan that cannot hold a full key is not read at
all. Then the key column alone is read into sketches of frequent items, one per task, which
are merged in two steps. Only the keys that a sketch proposes are counted exactly.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000

# A sketch of m items finds every key above 1 / (m / 7) of the rows. Its size is bounded
# whatever the number of keys; at most a megabyte a task is merged.
LEAST_TRACKED, MOST_TRACKED = 1024, 65_536
SKETCH_GROUPS = 256
# Footers of more files than this are not looked at.
MOST_FILES = 10_000

# Operators that give no more rows than they read.
_NOT_MORE = {
    "Project", "Filter", "Sort", "Window", "WindowGroupLimit", "Aggregate", "Distinct", "Deduplicate", "Repartition",
    "RepartitionByExpression", "RebalancePartitions", "GlobalLimit", "LocalLimit", "SubqueryAlias", "View", "CollectMetrics",
}
# No text codec has packed a row's least byte into less than this share of one.
_MOST_PACKED = 1100


@lru_cache(maxsize=1024)
def _counted(spark: SparkSession, names: tuple[str, ...], size: int) -> int:
    """Rows of some files, kept while their names and size stay; a stale count costs balance only."""
    return spark.read.parquet(*names).count()


def _footer_rows(df: DataFrame, node) -> int | None:
    """Rows of the files of a scan. Parquet counts without reading a data page."""
    relation = node.relation()
    if not hasattr(relation, "location"):
        return None
    form = relation.fileFormat().toString().lower()
    if form in ("csv", "text", "json"):
        return int(relation.sizeInBytes()) * _MOST_PACKED
    names = tuple(relation.location().inputFiles())
    if form != "parquet" or len(names) > MOST_FILES:
        return None
    return _counted(df.sparkSession, names, int(relation.sizeInBytes())) if names else 0


def _bound(df: DataFrame, node) -> int | None:
    kind = node.getClass().getSimpleName().rstrip("$")
    children = [node.children().apply(i) for i in range(node.children().size())]
    if kind == "LogicalRelation":
        return _footer_rows(df, node)
    if kind == "LocalRelation":
        return node.data().size()
    if kind not in _NOT_MORE | {"Union", "Join"}:
        return None
    bounds = []
    for child in children:
        bounds.append(_bound(df, child))
        if bounds[-1] is None:
            return None
    if kind == "Join":
        left, right = bounds
        if node.joinType().toString() in ("LeftSemi", "LeftAnti"):
            return left
        return max(left, 1) * max(right, 1)
    return sum(bounds)


def rows_at_most(df: DataFrame) -> int | None:
    """A bound of the frame's rows that holds whatever they contain; None if there is none.

    It comes from the footers of the files that the plan reads; an inner or outer join
    counts as the product of its sides.
    """
    return _bound(df, df._jdf.queryExecution().optimizedPlan())


def frequent_keys(df: DataFrame, key: str, tracked: int = MOST_TRACKED) -> DataFrame:
    """Rows (key, estimate): the keys that a sketch of that many items has kept.

    Every key with more than 7 / tracked of the rows is among them. No null key is.
    """
    item = F.expr(f"approx_top_k_accumulate(`{key}`, {tracked})").alias("sketch")
    keys = df.select(key).filter(F.col(key).isNotNull())
    # Tasks are many, and each has a sketch; they meet in groups before they meet in one.
    some = keys.groupBy((F.spark_partition_id() % SKETCH_GROUPS).alias("part")).agg(item)
    merged = some.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {tracked})")).alias("top"))
    return top.select(F.col("top.item").alias(key), F.col("top.count").alias("estimate"))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The keys with more than hot_rows rows, as a frame to broadcast; None if there is none.

    There are at most rows / hot_rows of them, and never more than a sketch tracks. Above
    hot_rows * tracked / 7 rows in all, only keys with more than their 7 / tracked are sure
    to be found; what is missed costs balance, no rows.
    """
    rows = rows_at_most(df)
    if rows is not None and rows <= hot_rows:
        return None
    wanted = MOST_TRACKED if rows is None else 8 * rows // max(hot_rows, 1)
    tracked = min(max(wanted, LEAST_TRACKED), MOST_TRACKED)
    proposed = frequent_keys(df, key, tracked).filter(F.col("estimate") > hot_rows).select(key)
    spark = df.sparkSession
    candidates = proposed.toArrow()
    if not candidates.num_rows:
        return None
    few = spark.createDataFrame(candidates)
    counts = df.select(key).join(F.broadcast(few), key).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    found = counts.filter(F.col("_rows") > hot_rows).select(key).toArrow()
    return F.broadcast(spark.createDataFrame(found)) if found.num_rows else None
