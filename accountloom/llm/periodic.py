"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of words with smallest period q, at least two periods and twelve words
long, that no neighbouring word extends. Periods under 16 are found by comparing a batch
of texts with itself moved by each of them. Longer ones belong to a scale: that of k
words covers the periods from 2k to 4k - 1. There every window of k neighbouring runs of
k words keeps those with the least hash. Windows one period apart in a run hold the same
words and keep the same places, so each run shows as a pair of equal minimizers its period
apart. Pairs are extended both ways by comparing hashes of stretches.

Repetitive text would tie everywhere. Runs of k words with a period of k / 2 or less, all
of them inside shorter runs found before, are therefore the last choice of a window: then
equal minimizers lie more than k / 2 apart, and a place has at most eight partners. A run
whose windows all fall inside shorter runs consists of two neighbouring shorter runs of
one period, and its period is read off where they meet.

Hashes propose. What is reported, and what is left out for having a smaller period, has
been compared word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountloom.llm.arrays import let
from accountloom.llm.common import prepare

LEAST_LENGTH = 12
LEAST_GRAM = 8
# Shorter periods are compared directly; documents lie this far apart in a batch.
DIRECT = 2 * LEAST_GRAM
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each window of that many values."""
    size = 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return pick(values[:-rest], values[rest:]) if rest else values


def _stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of each group of consecutive numbers."""
    if not len(places):
        return places, places
    cut = np.flatnonzero(np.diff(places) != 1)
    return places[np.r_[0, cut + 1]], places[np.r_[cut, len(places) - 1]] + 1


def _prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] if n > 1 else found


class Runs:
    """All runs of a batch of documents, given as arrays of word numbers.

    start, length, period and doc are arrays with an entry per run, by doc, start, period.
    """

    def __init__(self, words: np.ndarray, offsets: np.ndarray):
        sizes = np.diff(offsets)
        # Longest documents first: the larger a scale, the fewer of them take part.
        self._order = np.argsort(-sizes, kind="stable")
        self._sizes = sizes[self._order]
        self._starts = np.r_[0, np.cumsum(self._sizes + DIRECT)][:-1].astype(np.int64)
        self._ends = self._starts + self._sizes
        n = int(self._ends[-1]) + DIRECT if len(sizes) else 0
        # What lies between documents equals nothing else.
        self._words = -1 - np.arange(n, dtype=np.int64)
        for i, doc in enumerate(self._order.tolist()):
            self._words[self._starts[i] : self._ends[i]] = words[offsets[doc] : offsets[doc + 1]]
        found = self._all() if len(sizes) and self._sizes[0] >= LEAST_LENGTH else np.zeros((0, 3), np.int64)
        found = found[found[:, 1] - found[:, 0] >= LEAST_LENGTH]
        at = np.searchsorted(self._starts, found[:, 0], side="right") - 1 if len(found) else found[:, 0]
        doc = self._order[at] if len(found) else at
        start = found[:, 0] - self._starts[at] if len(found) else at
        rows = np.lexsort((found[:, 2], start, doc))
        self.doc, self.start = doc[rows], start[rows]
        self.length, self.period = (found[:, 1] - found[:, 0])[rows], found[rows, 2]

    def _hash(self) -> None:
        n = len(self._words)
        power = np.full(n, _BASE, np.uint64)
        power[0] = 1
        self._power = np.cumprod(power)
        power[1:] = pow(_BASE, -1, 1 << 64)
        self._inverse = np.cumprod(power)
        sums = np.cumsum(_mixed(self._words.view(np.uint64) + np.uint64(_BASE)) * self._power)
        self._sums = np.r_[np.uint64(0), sums]

    def _same(self, x: np.ndarray, q: np.ndarray, size: np.ndarray) -> np.ndarray:
        s = self._sums
        return (s[x + size] - s[x]) * self._power[q] == s[x + q + size] - s[x + q]

    def _common(self, x: np.ndarray, q: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many words from x on (or up to x) equal those q further, at most `most`."""
        low, high = np.zeros_like(most), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) >> 1
            hit = self._same(x - mid if back else x, q, mid)
            low, high = np.where(open_ & hit, mid, low), np.where(open_ & ~hit, mid - 1, high)
        return low

    def _equal(self, a: int, b: int, size: int) -> bool:
        return bool((self._words[a : a + size] == self._words[b : b + size]).all())

    def _lag(self, q: int, first: int, last: int) -> np.ndarray:
        """(start, end, q) of the stretches within first..last that have period q and two of them."""
        w = self._words[first:last]
        at, to = _stretches(np.flatnonzero(w[:-q] == w[q:]))
        long = to - at >= max(q, LEAST_GRAM - q)
        return np.stack([at[long] + first, to[long] + q + first, np.full(long.sum(), q)], 1).astype(np.int64)

    def _smallest(self, found: np.ndarray) -> np.ndarray:
        """The stretches that have no smaller period. With two periods, it would divide theirs."""
        keep = np.ones(len(found), bool)
        factors = {q: _prime_factors(q) for q in np.unique(found[:, 2]).tolist()}
        for i, (a, _, q) in enumerate(found.tolist()):
            keep[i] = not any(self._equal(a, a + q // p, q) for p in factors[q])
        return found[keep]

    def _extended(self, x: np.ndarray, q: np.ndarray) -> np.ndarray:
        """(start, end, q) of the stretches around the seeds that have two periods."""
        at = np.searchsorted(self._starts, x, side="right") - 1
        ahead = self._common(x, q, self._ends[at] - x - q)
        behind = self._common(x, q, x - self._starts[at], back=True)
        long = ahead + behind >= q
        found = np.unique(np.stack([x - behind, x + ahead + q, q], 1)[long], axis=0)
        sure = []
        for a, e, lag in found.tolist():
            if self._equal(a, a + lag, e - a - lag):
                sure.append(np.array([[a, e, lag]]))
            else:  # a hash took different words for equal ones
                doc = np.searchsorted(self._starts, a, side="right") - 1
                sure.append(self._lag(lag, int(self._starts[doc]), int(self._ends[doc])))
        return np.unique(np.concatenate(sure), axis=0) if sure else np.zeros((0, 3), np.int64)

    def _minimizer_pairs(self, k: int, n: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places x and lags q, from 2k to 4k - 1, of equal minimizers in the first n words."""
        grams = (self._sums[k : n + 1] - self._sums[: n + 1 - k]) * self._inverse[: n + 1 - k]
        inside = known[(2 * known[:, 2] <= k) & (known[:, 1] - known[:, 0] >= k) & (known[:, 1] <= n)]
        steps = np.zeros(len(grams) + 1, np.int32)
        np.add.at(steps, inside[:, 0], 1)
        np.add.at(steps, inside[:, 1] - k + 1, -1)
        short = np.cumsum(steps[:-1]) > 0
        rank = _mixed(grams) >> np.uint64(1)
        rank[short] |= np.uint64(1 << 63)
        least = _sliding(rank, k, np.minimum)
        # A place is kept if it is the least of some window that it lies in.
        edge = np.zeros(k - 1, np.uint64)
        kept = _sliding(np.concatenate([edge, least, edge]), k, np.maximum) == rank
        at = np.flatnonzero(kept & ~short)
        key = grams[at]
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        x, q, left = [], [], np.arange(len(at))
        step = 1
        while len(left):
            left = left[left + step < len(at)]
            lag = at[left + step] - at[left]
            near = (key[left + step] == key[left]) & (lag < 4 * k)
            left, lag = left[near], lag[near]
            x.append(at[left][lag >= 2 * k])
            q.append(lag[lag >= 2 * k])
            step += 1
        x, q = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (x, q))
        one = np.searchsorted(self._starts, x, side="right") == np.searchsorted(self._starts, x + q, side="right")
        return x[one], q[one]

    def _meeting_pairs(self, k: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same where a run consists of two neighbouring runs of one period, k / 2 or less."""
        long = known[(2 * known[:, 2] <= k) & (known[:, 1] - known[:, 0] >= 2 * k)]
        long = long[np.lexsort((long[:, 0], long[:, 2]))]
        x, q = [], []
        for (b, e, d), (c, f, d2) in zip(long[:-1].tolist(), long[1:].tolist()):
            if d != d2 or c > e:
                continue
            most = min(4 * k - 1, e - b, f - c)
            for lag in range(2 * k, min(2 * k + d, most + 1)):
                pattern = self._words[b + (c - lag - b + np.arange(d)) % d]
                if (pattern == self._words[c : c + d]).all():
                    lags = np.arange(lag, most + 1, d)
                    x.append(np.maximum(b, c - lags))
                    q.append(lags)
        none = np.zeros(0, np.int64)
        return (np.concatenate(x) if x else none), (np.concatenate(q) if q else none)

    def _all(self) -> np.ndarray:
        n = len(self._words)
        known = self._smallest(np.concatenate([self._lag(q, 0, n) for q in range(1, DIRECT)]))
        k = LEAST_GRAM
        if self._sizes[0] >= 4 * k:
            self._hash()
        while self._sizes[0] >= 4 * k:
            part = int(np.searchsorted(-self._sizes, -4 * k, side="right"))
            pairs = self._minimizer_pairs(k, int(self._ends[part - 1]), known), self._meeting_pairs(k, known)
            x, q = (np.concatenate(v) for v in zip(*pairs))
            known = np.concatenate([known, self._smallest(self._extended(x, q))])
            k *= 2
        return known


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words, and where each text's begin and end among them."""
    split = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
    flat, offsets = split.values, split.offsets.to_numpy()
    there = pc.greater(pc.binary_length(flat), 0)
    count = np.r_[0, np.cumsum(there.to_numpy(zero_copy_only=False))]
    return flat.filter(there), count[offsets].astype(np.int64)


def _analysed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        words, offsets = _words(batch.column("text"))
        found = Runs(words.dictionary_encode().indices.to_numpy(zero_copy_only=False), offsets)
        edges = np.searchsorted(found.doc, np.arange(batch.num_rows + 1)).astype(np.int32)
        fields = [pa.array(v.astype(np.int64)) for v in (found.start, found.length, found.period)]
        runs = pa.ListArray.from_arrays(pa.array(edges), pa.StructArray.from_arrays(fields, fields=list(RUN)))
        steps = np.zeros(len(words) + 1, np.int32)
        first = offsets[found.doc] + found.start
        np.add.at(steps, first + found.period, 1)
        np.add.at(steps, first + found.length, -1)
        stays = np.cumsum(steps[:-1]) == 0
        kept = words.filter(pa.array(stays))
        left = np.r_[0, np.cumsum(stays)][offsets]
        lists = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), kept)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets)), runs, pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Every document's doc_id, n_words, runs (start, length, period by start, then period) and collapsed.

    collapsed is the text's words joined by blanks, without those that some run contains
    after its first period. docs needs doc_id (an integer) and text; other columns are
    ignored. Null, empty and blank texts have no words, no runs and an empty collapsed
    text. Every row is judged by itself, also rows of one or no id. An empty table gives
    no rows. A text is one task's, however long: some 60 bytes of memory a word.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = "struct<start:bigint,length:bigint,period:bigint>"
    return rows.mapInArrow(_analysed, f"doc_id long, n_words long, runs array<{run}>, collapsed string")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text) in which each text whose id's crc32 ends in 0 repeats some words to its end.

    With h that number, g = h div 10 and n words, all words from a = g mod n on repeat
    the first 1 + (n - a) div (3 + g mod 8) of them. A null id changes nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+"), "")

    def planted(found: Column) -> Column:
        n = F.size(found).cast("long")
        g = F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        moved = F.transform(found, lambda w, i: F.when(i < a, w).otherwise(F.get(found, (a + (i - a) % p).cast("int"))))
        return F.when(n > 0, F.array_join(moved, " ")).otherwise("")

    text = F.when(h % 10 == 0, let(words, planted)).otherwise(F.col("text"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def summarised(found: DataFrame) -> DataFrame:
    """The rows of periodic_runs() as the number of runs, the longest one, and digests."""
    ranked = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period"))))
    best = F.get(ranked, F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("_best.start").alias("start"),
        (-F.col("_best.n")).alias("length"),
        F.col("_best.period").alias("period"),
        F.expr("(-1000 * _best.n) div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
