from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from accountloom.llm import suffixes
from accountloom.llm.queries import op3_suffix_dedup
from tests.llm.support import SF, clashing, documents, prose


def plain(texts: list[tuple], depth=50):
    """(id, kept, removed, spans) of each row by comparing all windows."""
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, text in texts:
        data = (text or "").encode()
        for p in range(len(data) - depth + 1):
            w = data[p : p + depth]
            first[w] = min(first.get(w, float("inf")), key(i))
    out = []
    for i, text in texts:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - depth + 1):
            if first[data[p : p + depth]] < key(i):
                gone[p : p + depth] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.append((i, np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), spans))
    return sorted(out, key=str)


def answer(df):
    rows = df.select("doc_id", "kept", "n_removed", "n_spans").collect()
    return sorted(((r.doc_id, bytes(r.kept), r.n_removed, r.n_spans) for r in rows), key=str)


def shared_passages():
    passage, other = prose(100, 30), prose(101, 40)
    texts = [(i, f"{prose(i, 40)} {passage} {prose(i + 500, 30)}") for i in range(0, 12)]
    texts += [(20 + i, prose(i, 40)[: 30 + 9 * i] + other[5 * i :]) for i in range(12)]
    texts += [(60, texts[3][1]), (61, texts[3][1]), (62, passage), (63, "x" * 300), (64, "x" * 49), (65, "x" * 51)]
    texts += [(70, None), (71, ""), (72, "short"), (73, "é" * 60), (74, "aé" + "é" * 60)]
    return texts


def test_against_brute_force(spark):
    texts = shared_passages()
    found = suffixes.without_repeats(clashing(documents(spark, texts)), block_bytes=2000)
    assert answer(found) == plain(texts)


@pytest.mark.parametrize("hot_strings", [1, 4, 16])
def test_hot_grams_are_dealt_by_window(spark, hot_strings):
    texts = shared_passages()
    stock = "the stock phrase that all of them have in common, "
    texts += [(200 + i, f"{prose(700 + i, 4)} {stock}{prose(800 + i % 7, 9)} {stock}{prose(i, 3)}") for i in range(40)]
    texts += [(None, texts[-1][1]), (230, texts[-2][1])]
    found = suffixes.without_repeats(clashing(documents(spark, texts)), block_bytes=2000, hot_strings=hot_strings)
    assert answer(found) == plain(texts)


@pytest.mark.parametrize("depth, gram", [(100, None), (100, 80), (30, None), (24, 24), (60, 29), (300, None)])
def test_other_depths(spark, depth, gram):
    texts = shared_passages() + [(i, prose(9, 90) + prose(i, 5)) for i in (90, 91)]
    found = suffixes.without_repeats(documents(spark, texts), depth, gram, block_bytes=2000)
    assert answer(found) == plain(texts, depth)


@pytest.mark.parametrize("depth, gram", [(100, 24), (50, 51), (50, 0), (50, 18)])
def test_depths_that_an_anchor_cannot_cover(spark, depth, gram):
    with pytest.raises(ValueError, match="gram"):
        suffixes.without_repeats(documents(spark, {1: "a"}), depth, gram)


def test_windows_of_a_stock_phrase_stay_small():
    """The windows of two million different surroundings reach a task in parts by hash."""
    rng = np.random.default_rng(5)
    hashes, docs = rng.integers(0, 2**63, (2, 300_000), dtype=np.uint64), rng.integers(0, 10**6, 300_000)
    hashes[:, 1000:2000] = hashes[:, :1000]
    found = suffixes.smaller_elsewhere(hashes, docs)
    assert (found[:1000] == (docs[1000:2000] < docs[:1000])).all() and not found[2000:].any()


def test_repeated_ids_null_ids_and_empty_table(spark):
    a, b = prose(1, 60), prose(2, 60)
    texts = [(5, a), (5, a), (None, a), (None, b), (None, b), (4, b), (9, b + a)]
    docs = documents(spark, texts)
    assert answer(suffixes.without_repeats(docs)) == plain(texts)
    assert suffixes.without_repeats(docs.limit(0)).collect() == []


def test_registered_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    wanted = {i: (len((t or "").encode()),) for i, t in docs}
    wanted = {i: (*wanted[i], n, s, hashlib.sha256(kept).hexdigest()) for i, kept, n, s in plain(docs)}
    rows = op3_suffix_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows} == wanted


def test_cleaned_keeps_the_columns(spark):
    docs = clashing(documents(spark, shared_passages()))
    found = suffixes.cleaned(docs)
    assert found.dtypes == docs.dtypes and found.count() == docs.count()
    for r in found.filter("doc_id IN (73, 74)").collect():
        assert set(r.text) <= {"a", "é"}


def test_grams_taken_some_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "WINDOWS_AT_ONCE", 3)
    texts = shared_passages()
    assert answer(suffixes.without_repeats(documents(spark, texts), block_bytes=2000)) == plain(texts)


def test_slices_do_not_matter(monkeypatch):
    texts = [(t or "").encode() for _, t in shared_passages()]

    class Fake:
        def __init__(self):
            self.texts = texts
            self.ends = np.cumsum([len(t) for t in texts])
            self.starts = self.ends - [len(t) for t in texts]

    whole = suffixes.Anchors(Fake())
    monkeypatch.setattr(suffixes, "AT_ONCE", 97)
    cut = suffixes.Anchors(Fake())
    for a in (whole, cut):
        windows = sorted(p for x, y in zip(a.first, a.last) for p in range(x, y + 1))
        assert windows == sorted(
            s + p for s, t in zip(Fake().starts, texts) for p in range(max(0, len(t) - 49))
        )
    assert dict(zip(whole.at.tolist(), whole.gram.tolist())) == dict(zip(cut.at.tolist(), cut.gram.tolist()))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=9, max_size=9), min_size=1, max_size=40), st.integers(1, 3))
def test_radix_groups_are_the_equal_rows(rows, letters):
    lines = np.array([[b % letters for b in r] for r in rows], np.uint8)
    group = suffixes.radix_groups([], lines)
    for i, a in enumerate(lines):
        same = [j for j, b in enumerate(lines) if (a == b).all()]
        assert (group[i] == -1) == (len(same) == 1)
        if len(same) > 1:
            assert set(np.flatnonzero(group == group[i])) == set(same)


@pytest.mark.parametrize("size", [1, 5, 8, 24, 31])
def test_gram_hashes_depend_on_the_bytes_alone(size):
    data = np.frombuffer(b"abracadabra" * 9, np.uint8)
    found = suffixes.gram_hashes(data, size)
    assert len(found) == len(data) - size + 1
    by = {}
    for i, h in enumerate(found.tolist()):
        assert by.setdefault(data[i : i + size].tobytes(), h) == h
    assert len(set(by.values())) == len(by)


def test_grams_spread_evenly_over_the_buckets():
    class Fake:
        def __init__(self, text):
            self.texts = [text]
            self.ends = np.array([len(text)])
            self.starts = np.array([0])

    text = np.random.default_rng(5).integers(97, 123, 200_000, dtype=np.uint8).tobytes()
    grams = suffixes.Anchors(Fake(text)).gram
    sizes = np.bincount(suffixes.buckets_of(grams, 64).astype(np.int64), minlength=64)
    assert sizes.max() < 1.5 * sizes.mean() and sizes.min() > 0.5 * sizes.mean()
