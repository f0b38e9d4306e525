"""Language-model scores: add-one unigrams and a hashed maximum-entropy model.

Training counts of all words are kept by 64-bit hash. A block of documents sends each
of its words once and gets the corpus counts back, so no word list passes the driver.

The model is class-factored. The most frequent words, and the end of a text, have
classes of their own in which a softmax chooses the word; every other word belongs to a
class by its last bytes, in which it is chosen by its add-one frequency. The class, and
the word within a frequent class, depend on hashed features of the words before: the
last word, the last two, and the one before the last alone. Probabilities sum to one
over all known words and one unknown word per class. Frequent classes and feature rows
grow with the training tokens, up to what a task can hold of the weights.

Weights are learned in rounds, each over another part of all training documents. In a
round every task takes gradient steps on its own documents from the common weights; the
changes are averaged per feature by how often each task saw it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountloom.llm.blocks import (
    BLOCK_BYTES,
    LEAST_BUCKETS,
    NO_ID,
    Block,
    block_count,
    buckets_of,
    in_blocks,
    slices,
)
from accountloom.llm.common import held_out, prepare, stored

FOLDS, HELD_OUT_FOLD = 7, 2
WORDS_PER_CLASS = 16
RARE_CLASSES = 17
# For up to FEW_TOKENS in training. Classes grow with the fourth root of the tokens and
# feature rows with the square root. Each task holds all weights, which bounds both.
FEW_TOKENS = 4_000_000
FREQUENT_CLASSES, MOST_CLASSES = 15, 96
FEATURE_BITS, MOST_BITS = 14, 17
FREQUENT = FREQUENT_CLASSES * WORDS_PER_CLASS
FEATURES = 3
ROUNDS = 3
BATCH = 4096
RATE = 0.25
CHUNK_ROWS = 256
END_HASH = np.uint64(0x9E3779B97F4A7C15)
BEGIN_HASH = np.uint64(0xD1B54A32D192ED03)


_PLACES = 16
_TABLE = np.random.default_rng(10).integers(0, 2**64, _PLACES * 256, dtype=np.uint64)
_STEP = np.uint64(0xA24BAED4963EE407)


def hashed(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of words, none of them empty, and the classes that rare ones belong to.

    A byte's part in the hash is a random number by its value and its place; places beyond
    sixteen take the same numbers times a power. The class goes by the last two bytes.
    """
    if not len(words):
        return np.empty(0, np.uint64), np.empty(0, np.uint8)
    _, offsets, data = words.buffers()
    at = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    starts, ends = at[:-1] - at[0], at[1:] - at[0]
    place = np.arange(len(text)) - np.repeat(starts, ends - starts)
    parts = _TABLE[(place % _PLACES) << 8 | text]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        powers = np.cumprod(np.full(int(place[far].max()) // _PLACES, _STEP, np.uint64))
        parts[far] *= powers[place[far] // _PLACES - 1]
    h = np.add.reduceat(parts, starts)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    last = text[ends - 1].astype(np.int64), text[np.maximum(ends - 2, starts)].astype(np.int64)
    return h ^ (h >> np.uint64(32)), ((31 * last[0] + last[1]) % RARE_CLASSES).astype(np.uint8)


def classes_for(tokens: int) -> int:
    """Frequent classes for so many training tokens."""
    return min(MOST_CLASSES, int(FREQUENT_CLASSES * max(1.0, tokens / FEW_TOKENS) ** 0.25))


def bits_for(tokens: int) -> int:
    """Binary digits of the number of feature rows for so many training tokens."""
    return min(MOST_BITS, FEATURE_BITS + round(np.log2(max(1.0, tokens / FEW_TOKENS)) / 2))


def in_training(doc_id: int) -> bool:
    return doc_id == NO_ID or zlib.crc32(str(doc_id).encode()) % FOLDS != HELD_OUT_FOLD


def numbered(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, all words as numbers of them, and words per text."""
    low = pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string()))
    cut = pc.ascii_split_whitespace(low)
    words, offsets = cut.values, cut.offsets.to_numpy().astype(np.int64)
    # A blank at either end of a text leaves an empty word there.
    empty = pc.equal(pc.binary_length(words), 0)
    before = np.r_[0, np.cumsum(empty.to_numpy(zero_copy_only=False))]
    sizes = np.diff(offsets) - np.diff(before[offsets])
    found = pc.dictionary_encode(words.filter(pc.invert(empty)))
    return found.dictionary, found.indices.to_numpy().astype(np.int64), sizes


class Lexicon:
    """The distinct words of some texts in order of their hashes, and the texts as numbers of them."""

    def __init__(self, texts: list[bytes]):
        distinct, tokens, self.sizes = numbered(texts)
        hashes, classes = hashed(distinct)
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.hashes, self.classes, self.tokens = hashes[order], classes[order], place[tokens]


_WORDS = "bucket int, block int, hashes binary, counts binary, classes binary"
_REPLY = "block int, bucket int, reply binary, stats binary"
_REPLY_TYPES = {"block": pa.int32(), "bucket": pa.int32(), "reply": pa.binary(), "stats": pa.binary()}


def _arrow(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({name: pa.array(columns[name], kind) for name, kind in types.items()})


def _narrow(counts: np.ndarray) -> bytes:
    return counts.astype("<u4" if counts.max(initial=0) < 2**32 else "<u8").tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u8" if n and len(data) == 8 * n else "<u4").astype(np.int64)


def counted(dealt: DataFrame, buckets: int) -> DataFrame:
    """Rows (block, bucket, reply, stats): the corpus counts of each block's words.

    reply has a training count per word that the block sent for the bucket, in its order.
    A bucket's first row also has stats: its most frequent words, and words and
    occurrences per rare class.
    """

    def ask(key: tuple, rows: pa.Table) -> pa.Table:
        block = Block(rows)
        words = Lexicon(block.texts)
        hashes, classes = words.hashes, words.classes
        learned = np.repeat([in_training(i) for i in block.ids.tolist()], words.sizes)
        counts = np.bincount(words.tokens[learned.astype(bool)], minlength=len(hashes))
        runs = slices(buckets_of(hashes, buckets).astype(np.int64))
        return _arrow(
            {
                "bucket": [r[0] for r in runs],
                "block": [key[0].as_py()] * len(runs),
                "hashes": [hashes[a:b].tobytes() for _, a, b in runs],
                "counts": [_narrow(counts[a:b]) for _, a, b in runs],
                "classes": [classes[a:b].tobytes() for _, a, b in runs],
            },
            {"bucket": pa.int32(), "block": pa.int32()}
            | {c: pa.binary() for c in ("hashes", "counts", "classes")},
        )

    def answer(key: tuple, rows: pa.Table) -> pa.Table:
        sent = [np.frombuffer(x, np.uint64) for x in rows.column("hashes").to_pylist()]
        sizes = [len(x) for x in sent]
        counts = [_wide(x, n) for x, n in zip(rows.column("counts").to_pylist(), sizes)]
        classes = np.frombuffer(b"".join(rows.column("classes").to_pylist()), np.uint8)
        words, first, inverse = np.unique(np.concatenate(sent), return_index=True, return_inverse=True)
        total = np.bincount(inverse, np.concatenate(counts), len(words)).astype(np.int64)
        kind, known = classes[first], total > 0
        seen = np.bincount(kind[known], minlength=RARE_CLASSES)
        often = np.bincount(kind[known], total[known], RARE_CLASSES).astype(np.int64)
        top = np.lexsort((words, -total))[: MOST_CLASSES * WORDS_PER_CLASS]
        stats = b"".join(
            x.astype("<u8").tobytes() for x in (seen, often, words[top], total[top], kind[top])
        )
        parts = np.split(total[inverse], np.cumsum(sizes)[:-1])
        return _arrow(
            {
                "block": rows.column("block").to_pylist(),
                "bucket": [key[0].as_py()] * len(sizes),
                "reply": [_narrow(x) for x in parts],
                "stats": [stats] + [None] * (len(sizes) - 1),
            },
            _REPLY_TYPES,
        )

    asked = dealt.select("block", "doc_id", "text").groupBy("block").applyInArrow(ask, _WORDS)
    return asked.groupBy("bucket").applyInArrow(answer, _REPLY)


@dataclass
class Vocabulary:
    """Corpus-wide numbers: tokens, distinct tokens, texts, and what the classes hold."""

    tokens: int
    distinct: int
    texts: int
    frequent: np.ndarray
    places: np.ndarray
    frequent_counts: np.ndarray
    rare_words: np.ndarray
    rare_tokens: np.ndarray

    @property
    def frequent_classes(self) -> int:
        return max(FREQUENT_CLASSES, -(-len(self.frequent) // WORDS_PER_CLASS))

    def placed(self, hashes: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each word, and its number within a frequent class or -1."""
        at = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
        place = np.where(self.frequent[at] == hashes, self.places[at], -1)
        kind = np.where(place >= 0, place // WORDS_PER_CLASS, self.frequent_classes + classes.astype(np.int64))
        return kind, np.where(place >= 0, place % WORDS_PER_CLASS, -1)


def vocabulary(replies: DataFrame, texts: int) -> Vocabulary:
    """What the driver keeps of the counts: some thousand numbers at most, whatever the corpus."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], []]
            for data in batch.column(0).to_pylist():
                values = np.frombuffer(data, "<u8").astype(np.int64)
                sums, tops = values[: 2 * RARE_CLASSES], values[2 * RARE_CLASSES :].reshape(3, -1)
                rows = (
                    np.r_[np.full(RARE_CLASSES, 0), tops[0]],
                    np.r_[np.arange(RARE_CLASSES), tops[2]],
                    np.r_[sums[:RARE_CLASSES], np.zeros(tops.shape[1], np.int64)],
                    np.r_[sums[RARE_CLASSES:], tops[1]],
                )
                for column, value in zip(out, (*rows,)):
                    column.append(value)
            is_word = [np.r_[np.zeros(RARE_CLASSES, bool), np.ones(len(x) - RARE_CLASSES, bool)] for x in out[0]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c)) for c in (*out, is_word)],
                names=["hash", "class", "words", "tokens", "is_word"],
            )

    rows = replies.filter("stats IS NOT NULL").select("stats").mapInArrow(
        unpack, "hash long, class long, words long, tokens long, is_word boolean"
    )
    sums = {
        r["class"]: (r["words"], r["tokens"])
        for r in rows.filter("NOT is_word").groupBy("class").agg(F.sum("words").alias("words"), F.sum("tokens").alias("tokens")).collect()
    }
    words = np.array([sums.get(i, (0, 0))[0] for i in range(RARE_CLASSES)], np.int64)
    tokens = np.array([sums.get(i, (0, 0))[1] for i in range(RARE_CLASSES)], np.int64)
    all_words, all_tokens = int(words.sum()), int(tokens.sum())
    # One place is the end's.
    places = classes_for(all_tokens + texts) * WORDS_PER_CLASS - 1
    top = rows.filter("is_word AND tokens > 0").orderBy(F.desc("tokens"), "hash").limit(places).collect()
    hashes = np.array([END_HASH] + [np.uint64(r["hash"] % 2**64) for r in top], np.uint64)
    counts = np.array([texts] + [r["tokens"] for r in top], np.int64)
    for r in top:
        words[r["class"]] -= 1
        tokens[r["class"]] -= r["tokens"]
    place = np.empty(len(hashes), np.int64)
    place[np.argsort(-counts, kind="stable")] = np.arange(len(hashes))
    order = np.argsort(hashes)
    return Vocabulary(
        all_tokens + texts, all_words + (texts > 0), texts,
        hashes[order], place[order], counts[order], words, tokens,
    )


def _mixed(h: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def features_of(last: np.ndarray, before: np.ndarray, bits: int = FEATURE_BITS) -> np.ndarray:
    """Buckets (FEATURES, n) of the contexts with these two words."""
    one, two = last * np.uint64(0xA0761D6478BD642F), before * np.uint64(0xE7037ED1A0B428DB)
    both, skipped = one + two * np.uint64(0x8EBC6AF09C88C6E3), two ^ np.uint64(0x589965CC75374CC3)
    return np.stack([_mixed(h, bits) for h in (one, both, skipped)])


def _inner(features: np.ndarray, kinds: np.ndarray, rows: int) -> np.ndarray:
    """Buckets of the same contexts for the words of a class."""
    return features ^ ((kinds * 0x9E5) & (rows - 1))


def _rows(table: np.ndarray, at: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    # All places exist; taking them unchecked is faster than an index.
    return np.take(table, at, axis=0, out=out, mode="clip")


def _scores(bias: np.ndarray, weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    out = _rows(weights, features[0])
    out += bias
    more = np.empty_like(out)
    for feature in features[1:]:
        out += _rows(weights, feature, more)
    return out


def _total(exponentials: np.ndarray) -> np.ndarray:
    return exponentials @ np.ones(exponentials.shape[1], exponentials.dtype)


def _in_range(total: np.ndarray) -> bool:
    """Biases are logs of shares, so sums of exponentials rarely leave the numbers' range."""
    return bool(np.isfinite(total).all()) and total.min(initial=1) > 1e-20


def _log_chosen(bias: np.ndarray, weights: np.ndarray, features: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The log of the softmax at one place of each row."""
    scores = _scores(bias, weights, features)
    own = scores[np.arange(len(chosen)), chosen].astype(np.float64)
    with np.errstate(over="ignore"):
        total = _total(np.exp(scores, out=scores))
    if _in_range(total):
        return own - np.log(total)
    scores = _scores(bias, weights, features)
    top = scores.max(axis=1)
    return own - top - np.log(_total(np.exp(scores - top[:, None])))


def _softmax(bias: np.ndarray, weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    shares = _scores(bias, weights, features)
    with np.errstate(over="ignore"):
        total = _total(np.exp(shares, out=shares))
    if not _in_range(total):
        shares = _scores(bias, weights, features)
        shares -= shares.max(axis=1, keepdims=True)
        total = _total(np.exp(shares, out=shares))
    shares *= (1 / total)[:, None]
    return shares


def _log_shares(counts: np.ndarray) -> np.ndarray:
    """Logs of counts over their sum along the last axis; -10,000 where a count is none."""
    there = counts > 0
    total = np.maximum(counts.sum(axis=-1, keepdims=True), 1)
    return np.where(there, np.log(np.where(there, counts, 1) / total), -1e4).astype(np.float32)


class Model:
    """Weights of the class softmax (outer) and of the word softmax within a class (inner)."""

    def __init__(self, vocab: Vocabulary):
        self.bits, classes = bits_for(vocab.tokens), vocab.frequent_classes
        size, frequent = 2**self.bits, classes * WORDS_PER_CLASS
        self.outer = np.zeros((size, classes + RARE_CLASSES), np.float32)
        self.inner = np.zeros((size, WORDS_PER_CLASS), np.float32)
        counts = np.zeros(frequent)
        counts[vocab.places] = vocab.frequent_counts
        counts = counts.reshape(classes, WORDS_PER_CLASS)
        used = np.zeros(frequent, bool)
        used[vocab.places] = True
        # Places without a word, and classes without any, have no probability.
        used = used.reshape(counts.shape)
        self.inner_bias = _log_shares(np.where(used, counts + 1, 0))
        outer = np.where(used.any(axis=1), counts.sum(axis=1) + 1, 0)
        self.outer_bias = _log_shares(np.r_[outer, vocab.rare_tokens + vocab.rare_words + 1.0])

    def log_probabilities(self, features: np.ndarray, kinds: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Natural logs of the class, times the word's within it where it is frequent."""
        n = len(kinds)
        out = np.empty(n)
        for at in range(0, n, 4 * BATCH):
            part = slice(at, at + 4 * BATCH)
            f, k = features[:, part], kinds[part]
            found = _log_chosen(self.outer_bias, self.outer, f, k)
            rows = np.flatnonzero(places[part] >= 0)
            g, k = _inner(f[:, rows], k[rows], len(self.inner)), k[rows]
            found[rows] += _log_chosen(self.inner_bias[k], self.inner, g, places[part][rows])
            out[part] = found
        return out


def _sums(rows: np.ndarray, at: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of rows[at] for each run of places: most runs are short, and added place by place."""
    out = _rows(rows, at[starts])
    longer, done = np.flatnonzero(sizes > 1), 1
    while len(longer) and done < 4:
        out[longer] += _rows(rows, at[starts[longer] + done])
        done += 1
        longer = longer[sizes[longer] > done]
    if len(longer):
        left = sizes[longer] - done
        first = np.cumsum(left) - left
        places = np.repeat(starts[longer] + done - first, left) + np.arange(left.sum())
        out[longer] += np.add.reduceat(_rows(rows, at[places]), first, axis=0)
    return out


class Trainer:
    """Gradient steps (Adagrad) on one task's documents from given weights."""

    def __init__(self, model: Model):
        self.start, self.model = model, Model.__new__(Model)
        self.model.__dict__ |= {k: v.copy() if isinstance(v, np.ndarray) else v for k, v in model.__dict__.items()}
        size = len(model.outer)
        self.seen = [np.zeros(size, np.int64), np.zeros(size, np.int64)]
        self._squares = [np.full_like(model.outer, 1e-2), np.full_like(model.inner, 1e-2)]

    def _step(self, which: int, weights: np.ndarray, rows: np.ndarray, wrong: np.ndarray) -> None:
        # Sixteen bits are sorted by radix.
        flat = rows.ravel().astype(np.uint16 if len(weights) <= 2**16 else np.uint32)
        order = np.argsort(flat, kind="stable")
        flat = flat[order].astype(np.int64)
        starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        sizes = np.diff(np.r_[starts, len(flat)])
        gradient = _sums(wrong, order % wrong.shape[0], starts, sizes)
        touched = flat[starts]
        squares = _rows(self._squares[which], touched)
        squares += gradient * gradient
        self._squares[which][touched] = squares
        np.sqrt(squares, out=squares)
        gradient *= RATE
        gradient /= squares
        weights[touched] -= gradient
        self.seen[which][touched] += sizes

    def learn(self, features: np.ndarray, kinds: np.ndarray, places: np.ndarray) -> None:
        model = self.model
        for at in range(0, len(kinds), BATCH):
            part = slice(at, at + BATCH)
            f, k, p = features[:, part], kinds[part], places[part]
            wrong = _softmax(model.outer_bias, model.outer, f)
            wrong[np.arange(len(k)), k] -= 1.0
            self._step(0, model.outer, f, wrong)
            rows = np.flatnonzero(p >= 0)
            if len(rows):
                g = _inner(f[:, rows], k[rows], len(model.inner))
                wrong = _softmax(model.inner_bias[k[rows]], model.inner, g)
                wrong[np.arange(len(rows)), p[rows]] -= 1.0
                self._step(1, model.inner, g, wrong)

    def changes(self) -> pa.RecordBatch:
        """What this task changed, by chunks: places of the rows it saw, changes, and how often it saw each."""
        out: list[tuple[int, bytes, bytes, bytes]] = []
        pairs = ((self.model.outer, self.start.outer), (self.model.inner, self.start.inner))
        for which, (now, then) in enumerate(pairs):
            for chunk, at in enumerate(range(0, len(now), CHUNK_ROWS)):
                part = slice(at, at + CHUNK_ROWS)
                seen = self.seen[which][part]
                rows = np.flatnonzero(seen)
                if len(rows):
                    change = (now[part][rows] - then[part][rows]).astype("<f2").tobytes()
                    out.append((2 * chunk + which, rows.astype("u1").tobytes(), change, seen[rows].astype("<u4").tobytes()))
        names = ("chunk", "places", "change", "seen")
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names
        )


def _sequence(words: Lexicon, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, each followed by its end, and the features before each."""
    end = len(words.hashes)
    sizes = words.sizes + 1
    starts = np.cumsum(sizes) - sizes
    whole = np.full(int(sizes.sum()), end)
    inside = np.ones(len(whole), bool)
    inside[starts + sizes - 1] = False
    whole[inside] = words.tokens
    own = np.r_[words.hashes, END_HASH][whole]
    last, before = np.r_[BEGIN_HASH, own[:-1]], np.r_[BEGIN_HASH, BEGIN_HASH, own[:-2]][: len(own)]
    last[starts] = BEGIN_HASH
    before[starts] = BEGIN_HASH
    before[(starts + 1)[sizes > 1]] = BEGIN_HASH
    return whole, features_of(last, before, bits)


def _learned(docs: DataFrame, vocab: Vocabulary, model: Model) -> None:
    """One round over the documents; the model's weights are changed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(model)
        for batch in batches:
            words = Lexicon([text or b"" for text in batch.column(0).to_pylist()])
            kinds, places = vocab.placed(np.r_[words.hashes, END_HASH], np.r_[words.classes, np.uint8(0)])
            whole, features = _sequence(words, model.bits)
            trainer.learn(features, kinds[whole], places[whole])
        yield trainer.changes()

    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, total, weight = None, None, None

        def close() -> pa.RecordBatch:
            mean = (total / np.maximum(weight, 1)[:, None]).astype("<f4").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([mean], pa.binary())], names=["chunk", "change"]
            )

        for batch in batches:
            for chunk, places, change, seen in zip(*(c.to_pylist() for c in batch.columns)):
                rows = np.frombuffer(places, "u1")
                seen = np.frombuffer(seen, "<u4").astype(np.float64)
                change = np.frombuffer(change, "<f2").astype(np.float64).reshape(len(seen), -1)
                if chunk != current:
                    if current is not None:
                        yield close()
                    current, total, weight = chunk, np.zeros((CHUNK_ROWS, change.shape[1])), np.zeros(CHUNK_ROWS)
                total[rows] += change * seen[:, None]
                weight[rows] += seen
        if current is not None:
            yield close()

    changes = docs.select(F.col("text").cast("binary")).mapInArrow(run, "chunk int, places binary, change binary, seen binary")
    means = changes.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(average, "chunk int, change binary")
    for row in means.collect():
        weights = (model.outer, model.inner)[row["chunk"] % 2]
        at = row["chunk"] // 2 * CHUNK_ROWS
        weights[at : at + CHUNK_ROWS] += np.frombuffer(row["change"], "<f4").reshape(-1, weights.shape[1])


def scored(
    docs: DataFrame, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    docs needs doc_id and text; other columns are ignored. Texts are lower-cased (A-Z),
    cut at ASCII blanks, and end with an end token; a null text has only that. Held-out
    documents are those whose crc32 of the id as text falls in the fold; they are scored
    and not learned from. A null id is not held out. Scores are base-10 logarithms of the
    whole text's probability. Repeated rows are counted and scored each by itself. An
    empty table gives no rows; without training documents every token is unknown.
    """
    prepare(docs.sparkSession)
    texts = docs.select("doc_id", "text")
    blocks = block_count(texts, block_bytes)
    buckets = max(LEAST_BUCKETS, blocks)
    dealt = in_blocks(texts, blocks)
    replies = stored(counted(dealt, buckets), "counts")
    training = texts.filter(~held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD))
    vocab = vocabulary(replies, training.count())
    model = Model(vocab)
    for turn in range(rounds):
        part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(rounds)) == turn
        _learned(training.filter(part), vocab, model)

    def score(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(rows)
        words = Lexicon(block.texts)
        answer = dict(zip(answers.column("bucket").to_pylist(), answers.column("reply").to_pylist()))
        counts = np.zeros(len(words.hashes) + 1, np.int64)
        for bucket, a, b in slices(buckets_of(words.hashes, buckets).astype(np.int64)):
            counts[a:b] = _wide(answer[bucket], b - a)
        counts[-1] = vocab.texts
        base = np.log10((counts + 1) / (vocab.tokens + vocab.distinct + 1))
        kinds, places = vocab.placed(np.r_[words.hashes, END_HASH], np.r_[words.classes, np.uint8(0)])
        rare = np.maximum(kinds - vocab.frequent_classes, 0)
        within = (counts + 1) / (vocab.rare_tokens + vocab.rare_words + 1)[rare]
        within = np.where(places >= 0, 0.0, np.log(within))
        whole, features = _sequence(words, model.bits)
        found = model.log_probabilities(features, kinds[whole], places[whole]) + within[whole]
        sizes = words.sizes + 1
        starts = np.cumsum(sizes) - sizes
        ids = block.ids.tolist()
        return pa.table(
            {
                "doc_id": block.doc_ids,
                "held_out": pa.array([not in_training(i) for i in ids], pa.bool_()),
                "n_tokens": pa.array(sizes, pa.int64()),
                "n_known": pa.array(np.add.reduceat((counts[whole] > 0).astype(np.int64), starts), pa.int64()),
                "train_tokens": pa.array([vocab.tokens] * len(ids), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base[whole], starts)),
                "score": pa.array(np.add.reduceat(found, starts) / np.log(10)),
            }
        )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    return (
        dealt.select("block", "doc_id", "text")
        .groupBy("block")
        .cogroup(replies.select("block", "bucket", "reply").groupBy("block"))
        .applyInArrow(score, schema)
    )
