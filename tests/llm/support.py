"""Inputs for the tests of this folder."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


def documents(spark: SparkSession, texts: dict | list) -> DataFrame:
    """Documents by id, or (id, text) pairs where ids repeat."""
    pairs = texts.items() if isinstance(texts, dict) else texts
    rows = [(i, t, "en", f"s{n % 3}", None if t is None else len(t)) for n, (i, t) in enumerate(pairs)]
    return spark.createDataFrame(rows, DOCS)


def clashing(docs: DataFrame) -> DataFrame:
    """The documents with further columns under names that the operators use inside."""
    names = ["block", "fp", "key", "ids", "hashes", "kept", "score", "rest", "length", "_doc", "u", "v", "id"]
    out = docs
    for name in names:
        out = out.selectExpr("*", f"'x' AS `{name}`")
    return out


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    own = random.Random(7)
    known = ["".join(own.choice("abcdefghij") for _ in range(own.randint(2, 8))) for _ in range(vocabulary)]
    return " ".join(rng.choice(known) for _ in range(words))
