from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from accountloom.llm import packing
from accountloom.llm.queries import op1_packing
from accountloom.llm.tokens import VOCABULARY, Encoder
from tests.llm.support import SF, clashing, documents, prose

ENCODER = Encoder()
LIBRARY = Tokenizer.from_file(VOCABULARY)


def library(text: str) -> np.ndarray:
    """The ids by the library as it is loaded."""
    return np.array(LIBRARY.encode(text, add_special_tokens=False).ids, "<u4")


def check(rows, texts: list[tuple], window=2048):
    """Every id in exactly one piece, and sequences without gaps."""
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    for doc_id, text in texts:
        ids = np.append(library(text or ""), 1).astype("<u4")
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    return len(sequences)


SPECIAL = "<|endoftext|>"
AROUND = ["", " ", "a", "\n", "  x ", "é", "<|", "|>", "<|endoftext", SPECIAL]


@pytest.mark.parametrize("before", AROUND)
@pytest.mark.parametrize("after", AROUND)
def test_special_tokens_as_the_library_reads_them(before, after):
    for text in (before + SPECIAL + after, f"{before}{SPECIAL} {SPECIAL}{after}", before + SPECIAL[:-1] + after):
        assert ENCODER.encode(text) == library(text).tobytes()
    assert 50256 in library(before + SPECIAL + after)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_both_libraries_give_the_same_ids(text):
    assert ENCODER.encode(text) == library(text).tobytes()


def test_both_libraries_on_documents_and_long_blanks(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for text in [*texts, " " * 20_000 + "x", "a" * 30_000, "<|endoftext|>", "\n" * 6000]:
        assert ENCODER.encode(text) == library(text).tobytes()


def test_registered_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = op1_packing(spark, SF).collect()
    sequences = check(rows, [(r.doc_id, r.text) for r in docs])
    tokens = sum(r.length for r in rows)
    assert sequences <= 1.02 * tokens / 2048 + 1


def test_small_window_cuts_and_packs(spark):
    texts = {i: prose(i, 5 + 3 * i) for i in range(60)} | {90: None, 91: "", 92: " ", 93: prose(1, 4000), 94: f"one {SPECIAL} two"}
    docs = clashing(documents(spark, texts))
    rows = packing.packed(docs, window=64, grain=4, least_cut=2).collect()
    assert {r for r in rows[0].asDict()} == {
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    }
    sequences = check(rows, list(texts.items()), 64)
    assert sequences <= 1.06 * sum(r.length for r in rows) / 64 + 1


def test_ids_of_pieces(spark):
    texts = {i: prose(i, 40) for i in range(9)}
    for r in packing.packed(documents(spark, texts), window=64, grain=4, with_ids=True).collect():
        ids = np.append(library(texts[r.doc_id]), 1).astype("<u4")
        assert r.ids == ids[r.start : r.start + r.length].tobytes()


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (None, "a b"), (2, None)])
    rows = packing.packed(docs).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 3), (1, 3), (1, 3), (2, 1)]
    assert packing.packed(docs.limit(0)).collect() == []


def test_least_squares_uses_up_a_fitting_histogram():
    combos = packing.combinations(16, 3)
    wanted = np.zeros(len(combos))
    wanted[[3, 10, 20]] = [100, 50, 25]
    histogram = np.zeros(17)
    for combo, n in zip(combos, wanted):
        for part in combo:
            histogram[part] += n
    histogram[0] = 0
    found = packing.repeat_counts(combos, histogram.copy())
    used = np.zeros(17)
    for combo, n in zip(combos, found):
        for part in combo:
            used[part] += n
    assert (found >= 0).all() and np.allclose(used[1:], histogram[1:], atol=1e-3)


@pytest.mark.parametrize(
    "histogram",
    [{}, {2048: 7}, {1100: 5000}, {1: 100_000}, {2047: 3, 1: 3}, {i: 50 + i % 7 for i in range(1, 2049)}],
)
def test_plan_places_every_token_once(histogram):
    plan = packing.planned(histogram)
    filled, seen = defaultdict(int), defaultdict(int)
    for found, rank, n, cut, length, first, repeats, slot, offset in plan.rows:
        for i in range(n):
            seen[found, rank + i] += length
            sequence = first + (slot + i) % repeats
            filled[sequence] += length
            assert offset + ((slot + i) // repeats + 1) * length <= 2048
    assert seen == {(x, i): x for x, n in histogram.items() for i in range(n)}
    assert max(filled.values(), default=0) <= 2048 and len(filled) == plan.sequences
    tokens = sum(x * n for x, n in histogram.items())
    assert plan.sequences <= 1.01 * tokens / 2048 + 1
