"""Quality rules: counts on words and lines, and a hashed n-gram likelihood ratio.

Everything is a built-in expression. Two multinomials over hashed words and word
pairs are counted, one from trusted documents and one from all. A document's score
is the mean log ratio of its n-grams, so length does not matter, and a fixed
threshold decides every document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountloom.llm.common import prepare, stored

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW_WORDS = 8  # fixed: repeated_words joins words three times
BUCKETS = 65_536
SMOOTHING = 10.0
THRESHOLD = -0.1
# The trusted multinomial is fitted on at most this many labelled documents, those
# with the smallest hash of their id; the raw multinomial counts every document.
MAX_TRUSTED = 200_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    found = F.split(trimmed, f"[{SPACES}]+")
    return F.when(F.length(trimmed) > 0, found).otherwise(F.array().cast("array<string>"))


def duplicate_lines(text: Column) -> Column:
    def count(lines: Column) -> Column:
        return F.size(lines) - F.size(F.array_distinct(lines))

    blank = f"[{SPACES}]*"
    lines = F.filter(F.split(text, "\n", -1), lambda x: ~x.rlike(f"\\A{blank}\\z"))
    return F.when(F.contains(text, F.lit("\n")), _let(lines, count)).otherwise(0)


def _repeated(windows: Column, size: int) -> Column:
    """Words covered by windows whose hash occurs at least twice."""

    def starts(ordered: Column) -> Column:
        def hit(x: Column, i: Column) -> Column:
            before, after = F.get(ordered, i - 1)["h"], F.get(ordered, i + 1)["h"]
            return F.struct(
                x["i"].alias("i"),
                F.coalesce((before == x["h"]) | (after == x["h"]), before == x["h"], after == x["h"], F.lit(False)).alias("hit"),
            )

        marked = F.filter(F.transform(ordered, hit), lambda x: x["hit"])
        return F.array_sort(F.transform(marked, lambda x: x["i"]))

    def cover(done: Column, i: Column) -> Column:
        end = i + size
        return F.struct(
            (done["n"] + end - F.greatest(done["end"], i)).alias("n"), end.alias("end")
        )

    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.aggregate(_let(ordered, starts), zero, cover, lambda done: done["n"])


def _joined(hashes: Column, gap: int) -> Column:
    """The hash of each element with the one that many places on."""

    def both(h: Column) -> Column:
        first = F.slice(h, 1, F.greatest(F.size(h) - gap, F.lit(0)))
        return F.transform(first, lambda x, i: F.xxhash64(x, F.get(h, i + gap)))

    return _let(hashes, both)


def repeated_words(pairs: Column) -> Column:
    """Words in windows of eight found at least twice in the text, the first included.

    pairs has the hash of each word with the next. Twice joined, they are the windows; a
    text in which no run of four words repeats is done after the first join.
    """

    def windows(eights: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(eights)) < F.size(eights), _repeated(eights, WINDOW_WORDS)
        ).otherwise(0)

    def fours(found: Column) -> Column:
        return F.when(
            F.size(F.array_distinct(found)) < F.size(found), _let(_joined(found, 4), windows)
        ).otherwise(0)

    return F.when(F.size(pairs) >= WINDOW_WORDS, _let(_joined(pairs, 2), fours)).otherwise(0)


def hashed(docs: DataFrame) -> DataFrame:
    """docs with words, hashes (of each word) and pairs (of each word and the next)."""
    worded = docs.withColumn("_words", words_of(F.coalesce("text", F.lit(""))))
    once = worded.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    return once.withColumn("_pairs", _joined(F.col("_hashes"), 1))


def measured(docs: DataFrame) -> DataFrame:
    """Documents with the base counts, _hashes and _pairs."""
    text = F.col("text")
    return hashed(docs).select(
        *docs.columns,
        "_hashes",
        "_pairs",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.coalesce(F.regexp_count(text, F.lit(f"[{SYMBOLS}]")), F.lit(0)).cast("long").alias("n_symbols"),
        F.coalesce(duplicate_lines(text), F.lit(0)).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_pairs")).cast("long").alias("n_repeat_words"),
    )


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(gram, F.lit(buckets)).cast("int")


def trusted_ids(labels: DataFrame, most: int = MAX_TRUSTED) -> DataFrame:
    """Ids of trusted documents: good quality and not toxic; most bounds their number."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
    return good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id")).limit(most)


def log_ratios(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING
) -> DataFrame:
    """One row (ratios): the log ratio of each bucket. trusted holds ids, few enough to broadcast.

    The raw counts are scaled to the size of the trusted ones before both are smoothed
    alike, so a bucket with few occurrences has a ratio near zero on any corpus.
    """
    ids = F.broadcast(trusted.select(F.col("doc_id").alias("_id"), F.lit(1).alias("_trusted")))
    texts = hashed(docs.select(F.col("doc_id").cast("long").alias("_id"), "text"))
    flagged = texts.select("_id", F.concat("_hashes", "_pairs").alias("_grams")).join(ids, "_id", "left")
    gram = flagged.select(F.coalesce("_trusted", F.lit(0)).cast("long").alias("t"), F.explode("_grams").alias("g"))
    counts = gram.groupBy(_bucket(F.col("g"), buckets).alias("b")).agg(F.sum("t").alias("t"), F.count(F.lit(1)).alias("n"))
    spark = docs.sparkSession
    full = spark.range(buckets).select(F.col("id").cast("int").alias("b")).join(F.broadcast(stored(counts, "grams")), "b", "left")
    rows = full.agg(
        F.array_sort(F.collect_list(F.struct("b", F.coalesce("t", F.lit(0)).alias("t"), F.coalesce("n", F.lit(0)).alias("n")))).alias("rows"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("all_t"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("all_n"),
    )
    a = F.lit(float(smoothing))

    def ratio(x: Column) -> Column:
        expected = x["n"] * F.col("all_t") / F.greatest("all_n", F.lit(1))
        return F.log(x["t"] + a) - F.log(expected + a)

    return rows.select(F.transform("rows", ratio).alias("ratios"))


def _scored(
    docs: DataFrame, trusted: DataFrame, buckets: int, threshold: float
) -> DataFrame:
    """The base counts and the verdict of every row; _doc holds the row itself."""
    prepare(docs.sparkSession)
    ratios = stored(log_ratios(docs, trusted, buckets), "ratios").scalar()
    found = measured(docs.select("doc_id", "text", F.struct("*").alias("_doc")))

    def total(grams: str) -> Column:
        ratio = lambda g: F.get(F.col("_ratios"), _bucket(g, buckets))
        return F.aggregate(grams, F.lit(0.0), lambda s, g: s + ratio(g))

    many = F.greatest(F.size("_hashes") + F.size("_pairs"), F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return (
        found.withColumn("_ratios", ratios)
        .withColumn("score", (total("_hashes") + total("_pairs")) / many)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    )


def judged(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Every document's doc_id, counts, base_failed, score (mean log ratio) and kept.

    docs needs doc_id and text; other columns are ignored. A null or blank text has no
    words, fails the base rules and has score zero. Repeated rows are judged alike,
    each by itself. Without trusted documents every ratio is zero and only the base
    rules reject. An empty table gives no rows.
    """
    return _scored(docs, trusted, buckets, threshold).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "score", "kept",
    )


def kept_documents(
    docs: DataFrame,
    trusted: DataFrame,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents judged fit, with all their columns."""
    return _scored(docs, trusted, buckets, threshold).filter("kept").select("_doc.*")
