"""Language identification by a convolutional network over bytes.

A window of bytes is embedded, passed through filters of several widths, pooled to
each filter's maximum, and classified by a softmax. The network is trained in numpy on
windows of a bounded sample of labelled documents. It is applied to all windows of
every text, and a text's scores are the means over its bytes. For applying, a filter of
four bytes is the sum of two tables over byte pairs, worked out once from the weights.

The network only tells the learned languages from each other. Whether a text is in one of
them at all goes by how usual its pairs of letters are in the sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountloom.llm.common import held_out, prepare

FOLDS, HELD_OUT_FOLD = 4, 2
WINDOW = 128
WIDTHS = (2, 3, 4)
SPAN = 4
FILTERS = 8
EMBEDDING = 8
# The network is fitted on at most so many documents of each language (those with the
# smallest hash of their id, and of these rows the smallest of id and text) and so many
# evenly spaced windows of each document.
DOCS_PER_LANGUAGE = 500
WINDOWS_PER_DOC = 12
RANKED_PARTS = 64
EPOCHS = 4
UNKNOWN = "und"
# A text's language must be so many times as likely as by chance.
LEAST_LIFT = 1.2
# Letters are told apart, in either case; all other bytes count as one.
_FOLD = np.zeros(256, np.uint16)
_FOLD[ord("A") : ord("Z") + 1] = _FOLD[ord("a") : ord("z") + 1] = np.arange(1, 27)
_FOLD[128:] = np.arange(27, 155)
_LETTERS = 155
# So many pairs of usual letters are added to each text: few letters prove nothing.
USUAL_PAIRS = 32
# The threshold lies by so much below the quantile of each language's own windows.
STRANGE_QUANTILE, STRANGE_MARGIN = 0.001, 0.5


def windows_of(text: bytes, size: int = WINDOW) -> np.ndarray:
    """All windows of the text, one after another; the last is filled with zero bytes."""
    rows = max(1, -(-len(text) // size))
    return np.frombuffer(text.ljust(rows * size, b"\0"), np.uint8).reshape(rows, size)


@dataclass
class Network:
    """languages, embedding (256, e), filters (SPAN * e, f), bias (f), dense (f, c), shift (c)."""

    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    dense: np.ndarray
    shift: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """What the first and the last two bytes of a filter's span add, for each byte pair."""
        e = self.embedding.shape[1]
        one = [self.embedding @ self.filters[i * e : (i + 1) * e] for i in range(SPAN)]
        front = (one[0][:, None, :] + one[1][None, :, :]).reshape(65_536, -1)
        back = (one[2][:, None, :] + one[3][None, :, :]).reshape(65_536, -1)
        return front, back

    def classify(self, pooled: np.ndarray) -> np.ndarray:
        hidden = np.maximum(pooled + self.bias, 0.0)
        scores = hidden @ self.dense + self.shift
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True)

    def probabilities(self, windows: np.ndarray, tables: tuple, at_once: int = 4096) -> np.ndarray:
        """One row of language probabilities per window."""
        front, back = tables
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), at_once):
            by_place = np.ascontiguousarray(windows[at : at + at_once].T).astype(np.int32)
            pairs = (by_place[:-1] << 8) | by_place[1:]
            best = np.full((pairs.shape[1], front.shape[1]), -np.inf, np.float32)
            sums, other = np.empty_like(best), np.empty_like(best)
            for place in range(len(by_place) - SPAN + 1):
                np.take(front, pairs[place], axis=0, out=sums, mode="clip")
                np.take(back, pairs[place + 2], axis=0, out=other, mode="clip")
                sums += other
                np.maximum(best, sums, out=best)
            out[at : at + at_once] = self.classify(best)
        return out


def train(
    windows: np.ndarray,
    labels: np.ndarray,
    languages: list[str],
    epochs: int = EPOCHS,
    filters: int = FILTERS,
    embedding: int = EMBEDDING,
    batch: int = 128,
    rate: float = 0.01,
    seed: int = 4,
) -> Network:
    """Fit the network by Adam on windows (n, size) with label numbers (n)."""
    rng = np.random.default_rng(seed)
    f, c = filters * len(WIDTHS), len(languages)
    mask = np.zeros((SPAN * embedding, f), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[: width * embedding, i * filters : (i + 1) * filters] = 1.0
    weights = {
        "embedding": rng.normal(0, 0.5, (256, embedding)),
        "filters": rng.normal(0, 0.3, (SPAN * embedding, f)) * mask,
        "bias": np.zeros(f),
        "dense": rng.normal(0, 0.3, (f, c)),
        "shift": np.zeros(c),
    }
    weights = {k: v.astype(np.float32) for k, v in weights.items()}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    # Languages count alike, however many windows each has.
    share = 1.0 / np.maximum(np.bincount(labels, minlength=c), 1)
    importance = (share / share[labels].mean())[labels].astype(np.float32)
    steps = 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            x, y = windows[rows], labels[rows]
            n, places = len(rows), x.shape[1] - SPAN + 1
            embedded = weights["embedding"][x]
            spans = np.lib.stride_tricks.sliding_window_view(embedded, (SPAN, embedding), axis=(1, 2))
            spans = spans.reshape(n, places, SPAN * embedding)
            answers = spans @ weights["filters"]
            best = answers.argmax(axis=1)
            pooled = np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0, :]
            raw = pooled + weights["bias"]
            hidden = np.maximum(raw, 0.0)
            scores = hidden @ weights["dense"] + weights["shift"]
            scores = np.exp(scores - scores.max(axis=1, keepdims=True))
            wrong = scores / scores.sum(axis=1, keepdims=True)
            wrong[np.arange(n), y] -= 1.0
            wrong *= importance[rows][:, None] / n
            back = (wrong @ weights["dense"].T) * (raw > 0)
            seen = spans[np.arange(n)[:, None], best]
            to_spans = back[:, :, None] * weights["filters"].T[None]
            to_embedding = np.zeros_like(weights["embedding"])
            bytes_seen = x[np.arange(n)[:, None, None], best[:, :, None] + np.arange(SPAN)]
            np.add.at(to_embedding, bytes_seen, to_spans.reshape(n, f, SPAN, embedding))
            gradients = {
                "embedding": to_embedding,
                "filters": np.einsum("nf,nfk->kf", back, seen) * mask,
                "bias": back.sum(axis=0),
                "dense": hidden.T @ wrong,
                "shift": wrong.sum(axis=0),
            }
            steps += 1
            for k, g in gradients.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                step = first[k] / (1 - 0.9**steps) / (np.sqrt(second[k] / (1 - 0.99**steps)) + 1e-7)
                weights[k] -= (rate * step).astype(np.float32)
    return Network(languages, *weights.values())


def _pairs(data: np.ndarray) -> np.ndarray:
    """Numbers of the byte pairs along the last axis; 0 where neither is a letter."""
    folded = _FOLD[data]
    return folded[..., :-1] * np.uint16(_LETTERS) + folded[..., 1:]


@dataclass
class Familiar:
    """Log probabilities of the second byte of each pair, their usual mean, and the least mean of a known text."""

    table: np.ndarray
    usual: float = 0.0
    least: float = -np.inf

    def score(self, pairs: np.ndarray) -> np.ndarray:
        """The mean over a text's pairs (the last axis) and the usual ones added to them."""
        n = (pairs > 0).sum(axis=-1)
        return (self.table[pairs].sum(axis=-1) + USUAL_PAIRS * self.usual) / (n + USUAL_PAIRS)

    def knows(self, text: bytes) -> bool:
        return bool(self.score(_pairs(np.frombuffer(text + b" ", np.uint8))) >= self.least)


def _familiar(pairs: np.ndarray, weights: np.ndarray) -> Familiar:
    counts = np.bincount(pairs.ravel(), np.repeat(weights, pairs.shape[1]), _LETTERS**2)
    counts[0] = 0.0
    counts = counts.reshape(_LETTERS, _LETTERS) + 0.01
    table = np.log(counts / counts.sum(axis=1, keepdims=True)).ravel()
    table[0] = 0.0
    found = pairs > 0
    mean = table[pairs].sum() / max(1, found.sum())
    return Familiar(table, float(mean))


def familiar(windows: np.ndarray, labels: np.ndarray) -> Familiar:
    """Fitted on the windows, with a threshold from halves scored by each other."""
    pairs = _pairs(windows)
    sizes = np.bincount(labels)
    weights = (len(labels) / len(sizes) / sizes)[labels]
    half = np.arange(len(labels)) % 2
    scores = np.empty(len(labels))
    for part in (0, 1):
        scores[half == part] = _familiar(pairs[half != part], weights[half != part]).score(pairs[half == part])
    out = _familiar(pairs, weights)
    lows = [np.quantile(scores[labels == i], STRANGE_QUANTILE) for i in range(len(sizes))]
    out.least = float(min(lows)) - STRANGE_MARGIN
    return out


def sample(
    docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE, windows_per_doc: int = WINDOWS_PER_DOC
) -> tuple[np.ndarray, np.ndarray, list[str]] | None:
    """Windows, label numbers and languages of documents with a text and a lang; None if there are none.

    The sample's ids are found first, from the narrow columns alone; only the sample's
    windows are read and brought to the driver.
    """
    named = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # A language that most documents have is ranked in parts first.
    part = F.pmod(F.shiftright(F.xxhash64("doc_id"), 32), F.lit(RANKED_PARTS))
    chosen = (
        named.select("doc_id", "lang")
        .withColumn("_rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(order)))
        .filter(F.col("_rank") <= docs_per_language)
        .withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy(order)))
        .filter(F.col("_rank") <= docs_per_language)
        .select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"))
        .distinct()
    )
    same = named["doc_id"].eqNullSafe(F.col("_id")) & (named["lang"] == F.col("_lang"))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            windows = []
            for text in batch.column(2).to_pylist():
                all_of = windows_of(text)
                places = np.unique(np.linspace(0, len(all_of) - 1, windows_per_doc).astype(int))
                windows.append(all_of[places].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(windows, pa.binary())], names=["lang", "hash", "windows"]
            )

    texts = named.join(F.broadcast(chosen), same, "left_semi").select(
        "lang", F.xxhash64("doc_id", "text").alias("hash"), F.col("text").cast("binary")
    )
    found = texts.mapInArrow(sampled, "lang string, hash long, windows binary")
    # Null ids and ids that repeat bring many rows: these are bounded too, in parts first.
    order, part = [F.col("hash"), F.col("windows")], F.pmod(F.shiftright("hash", 32), F.lit(RANKED_PARTS))
    for keys in (["lang", part], ["lang"]):
        ranked = found.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
        found = ranked.filter(F.col("_rank") <= docs_per_language).drop("_rank")
    rows = found.toArrow()
    if not rows.num_rows:
        return None
    pairs = sorted(
        (lang, data[at : at + WINDOW])
        for lang, data in zip(rows.column("lang").to_pylist(), rows.column("windows").to_pylist())
        for at in range(0, len(data), WINDOW)
    )
    languages = sorted({lang for lang, _ in pairs})
    number = {lang: i for i, lang in enumerate(languages)}
    windows = np.frombuffer(b"".join(w for _, w in pairs), np.uint8).reshape(len(pairs), -1)
    return windows, np.array([number[lang] for lang, _ in pairs]), languages


def fitted(
    docs: DataFrame,
    docs_per_language: int = DOCS_PER_LANGUAGE,
    windows_per_doc: int = WINDOWS_PER_DOC,
    epochs: int = EPOCHS,
) -> Network | None:
    """The network learned from documents with a text and a lang; None if there are none."""
    found = sample(docs, docs_per_language, windows_per_doc)
    return train(*found, epochs) if found else None


def _classifier(network: Network | None):
    """A function from texts (bytes, or None where there is nothing to classify) to languages and scores."""
    tables = network.tables() if network else None

    def classify(texts: list[bytes | None]) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        used = [i for i, t in enumerate(texts) if t] if network else []
        if used:
            windows = [windows_of(texts[i]) for i in used]
            found = network.probabilities(np.concatenate(windows), tables)
            sizes = np.array([len(w) for w in windows])
            lengths = np.array([len(texts[i]) for i in used])
            # A window weighs as many bytes as it has of the text.
            weights = np.full(len(found), float(WINDOW))
            ends = np.cumsum(sizes)
            weights[ends - 1] = lengths - (sizes - 1) * WINDOW
            sums = np.add.reduceat(found * weights[:, None], ends - sizes, axis=0)
            means = sums / lengths[:, None]
            for i, best, score in zip(used, means.argmax(axis=1), means.max(axis=1)):
                langs[i], scores[i] = network.languages[best], float(min(1.0, score))
        return langs, scores

    return classify


def _lettered_text() -> Column:
    """The text's bytes; null for a text without a letter."""
    return F.when(F.col("text").rlike("\\p{L}"), F.col("text").cast("binary"))


def predicted(docs: DataFrame, network: Network | None) -> DataFrame:
    """Rows (doc_id, lang_pred, score): only the text decides.

    A text that is null or has no letter is `und` with score 0, and so is every text if
    there is no network. Other texts get the language of the highest mean probability,
    the first by name at a tie. Whole texts are classified, an empty table gives no
    rows, and repeated rows are alike. Other columns are ignored.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = _classifier(network)
        for batch in batches:
            langs, scores = classify(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), _lettered_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def _outside() -> Column:
    return held_out(F.col("doc_id"), FOLDS, HELD_OUT_FOLD)


def identified(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), learned from the documents not held out."""
    prepare(docs.sparkSession)
    return predicted(docs, fitted(docs.filter(~_outside()))).withColumn("held_out", _outside())


def recognised(docs: DataFrame, least_score: float | None = None) -> DataFrame:
    """The documents in a known language by at least the score, with their own columns.

    Without a score it is 1.2 times chance. A text whose letter pairs are less usual than
    the sample's is in no known language, whatever its score; a few letters can be in any.
    A language much like a learned one in its letter pairs is not told from it.
    """
    prepare(docs.sparkSession)
    found = sample(docs.filter(~_outside()))
    network = train(*found, EPOCHS) if found else None
    known = familiar(*found[:2]) if found else None
    if least_score is None:
        # One language alone always has score one.
        least_score = LEAST_LIFT / len(network.languages) if network and len(network.languages) > 1 else 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify = _classifier(network)
        for batch in batches:
            last = batch.num_columns - 1
            texts = batch.column(last).to_pylist()
            langs, scores = classify(texts)
            good = [a != UNKNOWN and b >= least_score and known.knows(t) for a, b, t in zip(langs, scores, texts)]
            own = pa.RecordBatch.from_arrays(batch.columns[:last], schema=_nullable(batch.schema, last))
            yield own.filter(pa.array(good, pa.bool_()))

    return docs.select("*", _lettered_text().alias("_classified")).mapInArrow(run, docs.schema)


def _nullable(schema: pa.Schema, columns: int) -> pa.Schema:
    return pa.schema([pa.field(f.name, f.type) for f in list(schema)[:columns]])
