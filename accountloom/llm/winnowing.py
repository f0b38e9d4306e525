"""Benchmark decontamination by winnowing, in built-in expressions only.

A window is ten consecutive words of an item. Of the seven runs of four words in any ten
words, winnowing keeps the one with the least hash, so a document that shares a window
has kept the same run at the same place in it. Kept runs of documents and items are
joined, each hit is extended to the windows around it, and those are compared word by
word. Hashes only find candidates; they decide nothing.

Items of fewer words are one window each. Winnowing guarantees nothing for them, so for
the lengths that occur among them (nine at most) documents keep every run of that length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountloom.llm.arrays import let, run_hashes, window_minima
from accountloom.llm.common import prepare, stored

# What lies between words once A-Z are lower-case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
GRAM = 4
# A kept run is one number: the upper bits of its hash, then its place in the text.
PLACE_BITS = 30
PLACE = (1 << PLACE_BITS) - 1


def _split(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def words_of(text: Column) -> Column:
    """Words with A-Z lower-cased; none of a null."""
    return _split(F.translate(text, UPPER, LOWER))


def _word_hashes(text: Column) -> Column:
    """Hashes of the words lower-cased in full.

    That is faster and makes no two words differ that are equal with A-Z lower-cased.
    """
    return F.transform(_split(F.lower(text)), lambda w: F.xxhash64(w))


def _placed(hashes: Column) -> Column:
    return F.transform(hashes, lambda x, i: x.bitwiseAND(~PLACE).bitwiseOR(i.cast("long")))


def _hash_of(kept: Column) -> Column:
    return F.shiftright(kept, PLACE_BITS)


def fingerprints(texts: DataFrame, short: list[int], window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """texts with n_words and prints: the winnowed runs, and all runs of the short lengths."""

    def prints(hashes: Column) -> Column:
        def kept(runs: dict[int, Column]) -> Column:
            winnowed = window_minima(_placed(runs[gram]), window - gram + 1)
            return F.array_distinct(F.concat(winnowed, *[_placed(runs[m]) for m in short]))

        return run_hashes(hashes, sorted({gram, *short}), kept)

    hashed = texts.withColumn("_hashes", _word_hashes(F.col("text")))
    return hashed.select(
        *texts.columns, F.size("_hashes").cast("long").alias("n_words"), prints(F.col("_hashes")).alias("prints")
    )


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (window, item): the words of each window joined by blanks, and the items that have it."""
    worded = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words"))
    last = F.greatest(F.size("words") - window, F.lit(0))
    starts = F.sequence(F.lit(1), last + 1)
    windows = F.transform(starts, lambda i: F.array_join(F.slice("words", i, window), " "))
    return worded.filter(F.size("words") > 0).select("item", F.explode(windows).alias("window")).distinct()


def _item_prints(items: DataFrame, short: list[int], window: int, gram: int) -> DataFrame:
    """Rows (f, width): hashes of the runs that point to a window of that many words."""

    def own(n: int) -> Column:
        whole = run_hashes(_word_hashes(F.col("text")), [n], lambda runs: runs[n])
        return F.when(F.col("n_words") == n, F.transform(whole, lambda x: F.struct(_hash_of(x).alias("f"), F.lit(n).alias("width"))))

    found = fingerprints(items.select("text"), [], window, gram)
    long = F.transform("prints", lambda x: F.struct(_hash_of(x).alias("f"), F.lit(window).alias("width")))
    pointers = F.coalesce(*[own(n) for n in short], long)
    return found.select(F.inline(pointers)).distinct()


def _short_lengths(items: DataFrame, window: int) -> list[int]:
    """The lengths of items with fewer words than a window: at most window - 1 numbers."""
    n = F.size(_split(F.lower("text"))).alias("n")
    return sorted(r["n"] for r in items.select(n).filter((F.col("n") > 0) & (F.col("n") < window)).distinct().collect())


def _keys() -> list[Column]:
    """128 bits that tell rows with another id or text apart."""
    return [F.xxhash64("doc_id", "text").alias("_k"), F.xxhash64(F.lit("second"), "text", "doc_id").alias("_l")]


def _spans(found: Column) -> Column:
    """Overlapping and touching (start, end) put together, in order."""

    def add(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))
        return F.when((F.size(done) > 0) & (x["start"] <= last["end"]), grown).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(found), F.array().cast("array<struct<start:int,end:int>>"), add)


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Every document's doc_id, n_words, spans and items.

    spans holds the hit stretches as (start, end) in words, end excluded, in order and
    apart; items the ids, as sorted strings, of the items of which a window occurs. docs
    needs doc_id and text, items item_id and text; other columns are ignored.

    Null and blank texts have no words: such documents are not hit, such items hit
    nothing. Equal rows are judged alike, each by itself, null ids included. Item rows
    with one id are one item; those without an id are one item named by an empty string.
    Empty tables of documents give no rows, of items no hits.
    """
    spark = prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id"), F.col("text"))
    tests = items.select(F.col("item_id"), F.col("text"))
    short = _short_lengths(tests, window)

    prints = stored(_item_prints(tests, short, window, gram), "item-prints")
    # Items with the same windows are many copies of one text, so sets of items are few.
    sharing = item_windows(tests, window).groupBy("window").agg(F.array_sort(F.collect_list("item")).alias("items"))
    windows = stored(sharing.withColumn("items_id", F.sha2(F.to_json("items"), 256)), "item-windows")
    sets = stored(windows.select("items_id", "items").dropDuplicates(["items_id"]), "item-sets")

    marked = stored(
        fingerprints(texts.select("doc_id", "text", *_keys()), short, window, gram).drop("text"), "prints"
    )
    kept = marked.select("_k", "_l", F.explode("prints").alias("_print"))
    hits = kept.withColumn("f", _hash_of(F.col("_print"))).join(prints, "f")
    place = F.col("_print").bitwiseAND(PLACE).cast("int")
    reach = F.when(F.col("width") == window, window - gram).otherwise(0)
    places = hits.groupBy("_k", "_l").agg(
        F.collect_set(F.struct(place.alias("place"), "width", reach.alias("reach"))).alias("places")
    )

    def around(words: Column) -> Column:
        def starts(x: Column) -> Column:
            first, last = F.greatest(x["place"] - x["reach"], F.lit(0)), F.least(x["place"], F.size(words) - x["width"])
            all_of = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
            return F.transform(all_of, lambda i: F.struct(i.alias("start"), x["width"].alias("width")))

        tried = F.array_distinct(F.flatten(F.transform("places", starts)))
        return F.transform(
            tried,
            lambda x: F.struct(
                x["start"].alias("start"),
                (x["start"] + x["width"]).alias("end"),
                F.array_join(F.slice(words, x["start"] + 1, x["width"]), " ").alias("window"),
            ),
        )

    candidates = texts.select("text", *_keys()).join(stored(places, "places"), ["_k", "_l"])
    tried = candidates.select("_k", "_l", F.inline(let(words_of(F.col("text")), around)))
    found = tried.join(windows.select("window", "items_id"), "window").groupBy("_k", "_l").agg(
        F.collect_set(F.struct("start", "end")).alias("found"), F.collect_set("items_id").alias("ids")
    )
    found = stored(found.select("_k", "_l", _spans(F.col("found")).alias("spans"), "ids"), "hits")
    named = found.select("_k", "_l", F.explode("ids").alias("items_id")).join(sets, "items_id")
    items_of = named.groupBy("_k", "_l").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    answers = stored(found.join(items_of, ["_k", "_l"]).select("_k", "_l", "spans", "items"), "answers")
    return marked.select("doc_id", "n_words", "_k", "_l").join(answers, ["_k", "_l"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def counted(found: DataFrame) -> DataFrame:
    """The rows of contaminated() as counts and a digest of the items."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )
