from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from accountloom.llm import maxent
from accountloom.llm.queries import op10_lm_scoring
from tests.llm.support import SF, clashing, documents, prose

END = None
WORDS = maxent.FREQUENT - 10


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*low.encode().split(), END]


def plain(pairs):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in pairs}
    counts = Counter(t for i, x in pairs if not held[i] for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in pairs:
        found = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in found)
        out.append((i, held[i], len(found), sum(counts[t] > 0 for t in found), n, round(base, 6)))
    return sorted(out, key=str)


def answer(df):
    return sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str
    )


TEXTS = [(i, prose(i, 30 + i)) for i in range(60)] + [
    (100, None), (101, ""), (102, " \n\t"), (103, "UPPER upper Upper É é\x1cx"), (104, prose(1, 5000)), (7, prose(7, 37)), (None, "a b a"),
]


def test_base_scores_against_plain_counts(spark):
    df = maxent.scored(clashing(documents(spark, TEXTS)), block_bytes=2000)
    assert answer(df) == plain(TEXTS)
    assert all(math.isfinite(r.score) and r.score <= 0 for r in df.collect())


def test_registered_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert answer(op10_lm_scoring(spark, SF)) == plain(docs)


def test_empty_table_and_no_training_documents(spark):
    docs = documents(spark, TEXTS)
    assert maxent.scored(docs.limit(0)).collect() == []
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = maxent.scored(docs.filter(docs.doc_id.isin(held))).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0.0 and math.isfinite(r.score) for r in rows)


def test_the_model_beats_unigrams_on_held_out_texts(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(40)]
    texts = {}
    for i in range(300):
        at, out = int(rng.integers(40)), []
        for _ in range(60):
            out.append(words[at])
            at = (at * 7 + 3) % 40 if rng.random() < 0.9 else int(rng.integers(40))
        texts[i] = " ".join(out)
    rows = [r for r in maxent.scored(documents(spark, texts)).collect() if r.held_out]
    model, base = sum(r.score for r in rows), sum(r.base_score for r in rows)
    assert len(rows) > 20 and model > 0.6 * base


@pytest.fixture
def trained():
    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(1, 2**63, 300).astype(np.uint64))
    vocab = maxent.Vocabulary(
        10_000, 301, 50, hashes[:WORDS], rng.permutation(WORDS), rng.integers(1, 99, WORDS),
        rng.integers(0, 9, maxent.RARE_CLASSES), rng.integers(9, 99, maxent.RARE_CLASSES),
    )
    model = maxent.Model(vocab)
    model.outer += rng.normal(0, 1, model.outer.shape).astype(np.float32)
    model.inner += rng.normal(0, 1, model.inner.shape).astype(np.float32)
    return vocab, model


def test_probabilities_sum_to_one(trained):
    vocab, model = trained
    features = maxent.features_of(np.array([5], np.uint64), np.array([9], np.uint64))
    kinds = np.r_[np.sort(vocab.places) // maxent.WORDS_PER_CLASS, maxent.FREQUENT_CLASSES + np.arange(maxent.RARE_CLASSES)]
    places = np.r_[np.sort(vocab.places) % maxent.WORDS_PER_CLASS, np.full(maxent.RARE_CLASSES, -1)]
    found = model.log_probabilities(np.repeat(features, len(kinds), axis=1), kinds, places)
    # A rare class's own words and its unknown word share what the class has.
    assert np.exp(found).sum() == pytest.approx(1.0, abs=1e-4)


def test_steps_lower_the_loss(trained):
    vocab, model = trained
    rng = np.random.default_rng(2)
    words = rng.integers(0, WORDS, 3000)
    kinds, places = vocab.placed(vocab.frequent[words], np.zeros(3000, np.uint8))
    assert (kinds * maxent.WORDS_PER_CLASS + places == vocab.places[words]).all()
    features = maxent.features_of(vocab.frequent[words // 3], vocab.frequent[words // 5])
    before = model.log_probabilities(features, kinds, places).sum()
    trainer = maxent.Trainer(model)
    for _ in range(5):
        trainer.learn(features, kinds, places)
    assert trainer.model.log_probabilities(features, kinds, places).sum() > before + 1000
    assert np.array_equal(trainer.start.outer, model.outer)


def test_the_last_two_words_choose_within_a_class(trained):
    vocab, _ = trained
    model = maxent.Model(vocab)
    rng = np.random.default_rng(3)
    own = vocab.frequent[np.argsort(vocab.places)]
    first, second = rng.integers(0, 2, 4000), rng.integers(0, 2, 4000)
    # Either word alone says nothing about the next, and all of them are of one class.
    kinds, places = vocab.placed(own[first ^ second], np.zeros(4000, np.uint8))
    assert set(kinds) == {0}
    trainer = maxent.Trainer(model)
    features = maxent.features_of(own[first], own[second])
    for _ in range(20):
        trainer.learn(features, kinds, places)
    assert trainer.model.log_probabilities(features, kinds, places).mean() > -0.2


def test_the_model_grows_with_the_training_tokens(trained):
    vocab, model = trained
    assert maxent.FREQUENT >= 240 and model.outer.shape == (2**14, 15 + maxent.RARE_CLASSES)
    sizes = [10**n for n in range(0, 12)]
    classes, bits = [maxent.classes_for(n) for n in sizes], [maxent.bits_for(n) for n in sizes]
    assert classes == sorted(classes) and bits == sorted(bits)
    assert (classes[0], classes[8], bits[0], bits[8]) == (15, 33, 14, 16)


def test_words_beyond_the_least_classes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    # A word decides the next; 400 words, more than the least number of classes holds.
    texts = {}
    for i in range(300):
        at, out = int(rng.integers(400)), []
        for _ in range(100):
            out.append(f"w{at}")
            at = (at * 7 + 3) % 400 if rng.random() < 0.95 else int(rng.integers(400))
        texts[i] = " ".join(out)
    docs = documents(spark, texts)
    held = [r for r in maxent.scored(docs).collect() if r.held_out]
    monkeypatch.setattr(maxent, "FEW_TOKENS", 1000)
    grown = [r for r in maxent.scored(docs).collect() if r.held_out]
    assert sum(r.score for r in grown) > 0.9 * sum(r.score for r in held)
    assert answer(maxent.scored(docs)) == plain(list(texts.items()))


def hash_of(word):
    return int(maxent.hashed(pa.array([word], pa.binary()).view(pa.string()))[0][0])


def test_hashes_tell_words_apart():
    words = sorted({bytes(f"{i:x}", "ascii") * (1 + i % 5) for i in range(50_000)} | {b"x" * n for n in range(1, 300)})
    hashes, classes = maxent.hashed(pa.array(words, pa.binary()).view(pa.string()))
    assert len(set(hashes.tolist())) == len(words)
    assert set(classes.tolist()) == set(range(maxent.RARE_CLASSES))
    assert [int(h) for h in hashes[::997]] == [hash_of(w) for w in words[::997]]


def test_contexts_do_not_cross_texts():
    words = maxent.Lexicon([b"a b", b"", b"c"])
    whole, features = maxent._sequence(words)
    by = {hash_of(w): w for w in (b"a", b"b", b"c")}
    names = [by[int(h)] for h in words.hashes] + [None]
    assert [names[i] for i in whole] == [b"a", b"b", None, None, b"c", None]
    begin, a, b, c = maxent.BEGIN_HASH, *(hash_of(w) for w in (b"a", b"b", b"c"))
    last = np.array([begin, a, b, begin, begin, c], np.uint64)
    before = np.array([begin, begin, a, begin, begin, begin], np.uint64)
    assert np.array_equal(features, maxent.features_of(last, before))


@pytest.mark.parametrize("texts", [[], [b""], [b" b a  b\n", b"", b"c A\x1c \x0b\x0cd", b"\xc3\x89 \xff\xfe e", b" "]])
def test_words_are_numbered(texts):
    words = maxent.Lexicon(texts)
    assert (np.diff(words.hashes.astype(object)) > 0).all()
    wanted = [t.lower().split() for t in texts]
    assert words.sizes.tolist() == [len(w) for w in wanted]
    assert [int(words.hashes[i]) for i in words.tokens] == [hash_of(w) for ws in wanted for w in ws]


@pytest.mark.parametrize("scale", [1, 40, 300])
def test_softmax_of_any_weights(scale):
    rng = np.random.default_rng(scale)
    weights = (scale * rng.normal(size=(64, 7))).astype(np.float32)
    bias = maxent._log_shares(np.array([5.0, 0, 1, 1, 90, 3, 0]))
    features, chosen = rng.integers(0, 64, (3, 200)), rng.choice([0, 2, 3, 4, 5], 200)
    scores = bias.astype(np.float64) + weights[features].astype(np.float64).sum(axis=0)
    scores -= scores.max(axis=1, keepdims=True)
    wanted = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
    found = maxent._log_chosen(bias, weights, features, chosen)
    assert np.allclose(found, wanted[np.arange(200), chosen], rtol=1e-3, atol=1e-3)
    assert np.allclose(maxent._softmax(bias, weights, features), np.exp(wanted), atol=1e-4)


def test_sums_of_runs():
    rng = np.random.default_rng(1)
    sizes = np.r_[rng.integers(1, 9, 40), 1, 300, 1]
    at = rng.integers(0, 50, sizes.sum())
    rows, starts = rng.normal(size=(50, 6)), np.cumsum(sizes) - sizes
    assert np.allclose(maxent._sums(rows, at, starts, sizes), np.add.reduceat(rows[at], starts, axis=0))
