"""URL filtering by host rules and, where none applies, by a tree of path templates.

Each host has a tree of path segments. Segments that vary (numbers, hashes, or
values too rare or too many to be names) become wildcards, level by level. Branches
whose labelled rate does not differ from their parent's beyond chance are merged into
it. A template's share of bad labels is smoothed towards its parent's, the host's and
at last the corpus's; templates whose smoothed share reaches a threshold are rejected.
The labels are the rules' own verdicts on the URLs that they cover.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountloom.llm.common import prepare, stored

DEPTH = 4
MIN_SUPPORT = 5
MAX_CHILDREN = 50
MIN_SHARE = 0.01
PRIOR = 2.0
Z = 1.96
REJECT_AT = 0.8


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains, and paths that start with the path."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0].lower()

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def located(pages: DataFrame) -> DataFrame:
    """Rows (page_id, host, path); both are empty for a null url or one without ://."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract("_rest", "\\A[^/?#]*", 0)
    path = F.regexp_extract(F.substring("_rest", F.length(host) + 1, F.length("_rest")), "\\A[^?#]*", 0)
    return pages.select("page_id", rest.alias("_rest")).select(
        "page_id", _lower(host).alias("host"), path.alias("path")
    )


def _by_rule(rules: list[Rule], value) -> Column:
    """value(rule) of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    # At equal length the longer host wins, then a block.
    ranked = sorted(rules, key=lambda r: (len(r.text), len(r.host), r.verdict == "block"))
    for rule in ranked:
        fits = (F.col("host") == rule.host) | F.endswith("host", F.lit(f".{rule.host}"))
        out = F.when(fits & F.startswith("path", F.lit(rule.path)), F.lit(value(rule))).otherwise(out)
    return out


def _shape(segment: Column) -> Column:
    hashed = F.regexp_replace(segment, "\\A[0-9a-fA-F-]{16,}\\z", "<hash>")
    return F.regexp_replace(hashed, "[0-9]+", "<n>")


def _segments(path: Column, depth: int) -> Column:
    """The first segments' shapes; what lies deeper is one wildcard."""
    parts = F.split(path, "/", -1)
    named = F.transform(F.slice(parts, 2, depth), _shape)
    return F.when(F.size(parts) - 1 > depth, F.concat(named, F.array(F.lit("**")))).otherwise(named)


def _prefix(size: int, of: str = "template") -> Column:
    return F.slice(of, 1, size)


def _generalised(paths: DataFrame, depth: int, support: int, children: int, share: float) -> DataFrame:
    """paths (host, shape, n, good, bad) with a column template: shape with wildcards.

    A level's names are judged below the template found for the levels above it.
    """
    out = paths.withColumn("template", F.col("shape"))
    for level in range(depth):
        deep = out.withColumn("above", _prefix(level)).withColumn("name", F.get("template", F.lit(level)))
        names = stored(
            deep.filter("name IS NOT NULL").groupBy("host", "above", "name").agg(F.sum("n").alias("n")),
            "names",
        )
        nodes = stored(
            names.groupBy("host", "above").agg(F.count(F.lit(1)).alias("names"), F.sum("n").alias("total")),
            "nodes",
        )
        varies = (F.col("n") < support) | (
            (F.col("names") > children) & (F.col("n") < share * F.col("total"))
        )
        wild = stored(
            names.join(nodes, ["host", "above"]).filter(varies).select("host", "above", "name", F.lit(True).alias("wild")),
            "wildcards",
        )
        starred = F.concat(
            "above", F.array(F.lit("*")), F.slice("template", level + 2, F.greatest(F.size("template") - level - 1, F.lit(0)))
        )
        out = stored(
            deep.join(wild, ["host", "above", "name"], "left").select(
                "host", "shape", "n", "good", "bad",
                F.when(F.coalesce("wild", F.lit(False)), starred).otherwise(F.col("template")).alias("template"),
            ),
            "templates",
        )
    return out


def _purity(paths: DataFrame, depth: int, prior: float, z: float) -> DataFrame:
    """Rows (host, template, branch, share): branch is the template's part not merged into a parent."""
    counts = [F.sum("good").alias("good"), F.sum("bad").alias("bad")]
    leaves = stored(paths.groupBy("host", "template").agg(*counts), "leaves")
    total = leaves.agg(*[F.coalesce(c, F.lit(0)) for c in (F.sum("good"), F.sum("bad"))]).first()
    corpus = (total[1] + 1.0) / (total[0] + total[1] + 2.0)
    hosts = leaves.groupBy("host").agg(*counts)
    share = (F.col("bad") + prior * corpus) / (F.col("good") + F.col("bad") + prior)
    empty = F.array().cast("array<string>")
    above = stored(
        hosts.select("host", empty.alias("prefix"), empty.alias("branch"), share.alias("share")), "level"
    )
    for level in range(1, depth + 2):
        own = leaves.filter(F.size("template") >= level).groupBy("host", _prefix(level).alias("prefix")).agg(*counts)
        parents = above.select(
            "host",
            F.col("prefix").alias("parent"),
            F.col("branch").alias("parent_branch"),
            F.col("share").alias("rate"),
        )
        joined = own.withColumn("parent", _prefix(level - 1, "prefix")).join(parents, ["host", "parent"])
        n = F.col("good") + F.col("bad")
        spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / F.greatest(n, F.lit(1)))
        differs = (n > 0) & (F.abs(F.col("bad") / F.greatest(n, F.lit(1)) - F.col("rate")) > z * spread)
        smoothed = (F.col("bad") + prior * F.col("rate")) / (n + prior)
        level_rows = stored(
            joined.select(
                "host", "prefix",
                F.when(differs, F.col("prefix")).otherwise(F.col("parent_branch")).alias("branch"),
                F.when(differs, smoothed).otherwise(F.col("rate")).alias("share"),
            ),
            "level",
        )
        above = above.unionByName(level_rows)
    return leaves.select("host", F.col("template").alias("prefix")).join(above, ["host", "prefix"]).select(
        "host", F.col("prefix").alias("template"), "branch", "share"
    )


def judged(
    pages: DataFrame,
    rules: list[Rule],
    depth: int = DEPTH,
    min_support: int = MIN_SUPPORT,
    max_children: int = MAX_CHILDREN,
    min_share: float = MIN_SHARE,
    prior: float = PRIOR,
    z: float = Z,
    reject_at: float = REJECT_AT,
) -> DataFrame:
    """Every page's host, path, rule, template, branch, share of bad labels and verdict.

    pages needs page_id and url; other columns are ignored. A null url, or one without
    ://, has empty host and path and is judged as a host of its own. Of rules that fit, the
    longest counts; of equally long ones that with the longer host, then one that blocks.
    Repeated rows stay repeated. Without any label the corpus's share is one half and nothing is rejected.
    An empty table gives no rows. Levels below depth are one wildcard.
    """
    prepare(pages.sparkSession)
    placed = located(pages).select(
        "*",
        _by_rule(rules, lambda r: r.text).alias("rule"),
        _by_rule(rules, lambda r: r.verdict).alias("ruled"),
        _segments(F.col("path"), depth).alias("shape"),
    )
    paths = stored(
        placed.groupBy("host", "shape").agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.coalesce(F.col("ruled") == "allow", F.lit(False))).alias("good"),
            F.count_if(F.coalesce(F.col("ruled") == "block", F.lit(False))).alias("bad"),
        ),
        "paths",
    )
    shaped = _generalised(paths, depth, min_support, max_children, min_share)
    rated = stored(
        shaped.join(stored(_purity(shaped, depth, prior, z), "purity"), ["host", "template"]).select(
            "host", "shape", "template", "branch", "share"
        ),
        "rated",
    )
    found = placed.join(rated, ["host", "shape"])
    method = F.when(F.col("share") >= reject_at, "block").otherwise("allow")
    return found.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"),
        F.concat(F.lit("/"), F.concat_ws("/", "template")).alias("template"),
        F.concat(F.lit("/"), F.concat_ws("/", "branch")).alias("branch"),
        "share",
    )
