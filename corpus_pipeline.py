"""Documents in, training sequences out: one stage after another, each over all its input.

Every stage takes (spark, docs, sf_dir) and returns a frame, which is written as
Parquet and read again as the next stage's documents. All stages but the last return
the columns of documents. Rows with a null or empty text, or one without a letter, end
at the first stage; an empty table passes through all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.llm import language, packing, quality, simhash, suffixes
from accountloom.llm.common import stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go."""
    return language.recognised(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that fail the base rules or are unlike the trusted labelled ones."""
    return quality.kept_documents(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.one_per_group(docs)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings that a document with a smaller id has too are cut from the texts."""
    cut = suffixes.cleaned(docs)
    if "n_chars" not in docs.columns:
        return cut
    n_chars = F.length("text").cast(dict(docs.dtypes)["n_chars"])
    return cut.withColumn("n_chars", n_chars)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their place in the training sequences."""
    return packing.packed(docs)


STAGES = [
    ("language ID", known_language),
    ("quality rules", good_quality),
    ("SimHash near-dedup", no_near_duplicates),
    ("suffix-array dedup", no_repeats),
    ("packing", sequences),
]

# The models of the first two stages and the tokens cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
