from __future__ import annotations

import random
import time

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accountloom.llm import pieces
from accountloom.llm.queries import op6_sentencepiece
from tests.llm.support import SF, clashing, documents, prose

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
LOADED = pieces.Pieces.load()

TEXTS = [
    None, "", " ", "a", "  a  b ", "a\tb\nc", "héllo 中文 あ", "a\xa0b", "ﬁ ①", "x▁y ▁", "\x00a", "x\r\ny", "<s> </s> <unk> <0x41>",
    "é" * 70, "a" * 500, "🙂🙂 x", " " * 40, "antidisestablishmentarianism " * 3, prose(1, 300), "ab" * 3000,
]


def test_ids_are_the_library_s(spark):
    docs = clashing(documents(spark, dict(enumerate(TEXTS))))
    found = {r.doc_id: r.ids for r in pieces.encoded(docs, bucket_bytes=500, block_bytes=300).collect()}
    assert found == {i: LIBRARY.encode(t or "") for i, t in enumerate(TEXTS)}


def test_decoding_is_the_library_s(spark):
    rng = random.Random(1)
    ids = [LIBRARY.encode(t or "") for t in TEXTS] + [[rng.randrange(259, 32_000) for _ in range(9)] for _ in range(20)]
    rows = spark.createDataFrame([(i, x, "c") for i, x in enumerate(ids)] + [(-1, None, "c")], "doc_id long, ids array<int>, names string")
    found = {r.doc_id: r.decoded for r in pieces.decoded(rows).collect()}
    assert found.pop(-1) is None
    assert found == {i: LIBRARY.decode(x) for i, x in enumerate(ids)}


def test_registered_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op6_sentencepiece(spark, SF).collect()
    assert {r.doc_id: r.ids for r in rows} == {i: LIBRARY.encode(t or "") for i, t in docs.items()}
    assert all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, [(1, "a b"), (1, "a b"), (None, "c")])
    assert sorted((r.doc_id or 0, r.ids) for r in pieces.encoded(docs).collect()) == [
        (0, LIBRARY.encode("c")), (1, LIBRARY.encode("a b")), (1, LIBRARY.encode("a b")),
    ]
    assert pieces.encoded(docs.limit(0)).collect() == []


def test_folded_units_are_the_library_s(spark):
    """Every piece of the vocabulary in a row, and random strings of pieces up to the longest folded."""
    rng = random.Random(6)
    names = [n for n, ok in zip(LOADED.names, LOADED.normal) if ok and pieces.BLANK not in n]
    units = {pieces.BLANK + n for n in names if len(n) < 60}
    for _ in range(4000):
        unit = "".join(rng.choice(names) for _ in range(rng.randint(1, 12)))
        units.add(pieces.BLANK * rng.randint(1, 3) + unit[:57])
    rows = spark.createDataFrame([(u,) for u in sorted(units)], "unit string")
    found = pieces.encoded_units(rows, LOADED, ["unit"]).collect()
    assert len(found) > 0.6 * len(units)
    for r in found:
        assert r.ids == LIBRARY.encode(r.unit[1:].replace(pieces.BLANK, " ")), r.unit


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("abehnorstxé ▁\n中🙂."), max_size=40))
def test_long_units_are_merged_alike(text):
    long = pieces.LongUnits(LOADED)
    assert [i for u in pieces.units_of(text) for i in long.ids(u)] == LIBRARY.encode(text)


def best_sum(unit, scores, unknown):
    best = [0.0] + [float("-inf")] * len(unit)
    for end in range(1, len(unit) + 1):
        for start in range(end):
            score = scores.get(unit[start:end], unknown if end - start == 1 else float("-inf"))
            best[end] = max(best[end], best[start] + score)
    return best[-1]


def test_viterbi_finds_the_best_sum(spark):
    rng = random.Random(2)
    names = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(30)} - {"c"})
    scores = {n: -rng.randint(1, 40) / 4 for n in names}
    own = pieces.Pieces([f"<0x{i:02X}>" for i in range(256)] + names, [0.0] * 256 + [scores[n] for n in names], [False] * 256 + [True] * len(names), 0, False)
    units = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 12))) for _ in range(80)})
    rows = pieces.encoded_units(spark.createDataFrame([(u,) for u in units], "unit string"), own, ["unit"]).collect()
    assert len(rows) == len(units)
    unknown = min(scores.values()) - 10.0
    long = pieces.LongUnits(own)
    assert [r.ids for r in rows] == [long.ids(r.unit) for r in rows]
    for r in rows:
        parts = [own.names[i] if i >= 256 else chr(i) for i in r.ids]
        assert "".join(parts) == r.unit
        assert sum(scores.get(p, unknown) for p in parts) == pytest.approx(best_sum(r.unit, scores, unknown))


def test_units_of_a_unigram_model_do_not_depend_on_length(spark):
    own = pieces.Pieces([f"<0x{i:02X}>" for i in range(256)] + ["▁", "a", "b", "aab", "ba", "ab"], [0.0] * 256 + [-1.0, -2.0, -2.0, -2.5, -3.0, -2.9], [False] * 256 + [True] * 6, 0, False)
    rng = random.Random(3)
    texts = {n: "".join(rng.choice("aab") for _ in range(n)) for n in (1, 20, 57, 58, 59, 60, 61, 62, 64, 200)}
    found = {r.doc_id: r.ids for r in pieces.encoded(documents(spark, texts), own).collect()}
    unit = lambda t: spark.createDataFrame([(pieces.BLANK + t,)], "unit string")
    for n, text in texts.items():
        assert found[n] == pieces.encoded_units(unit(text), own, ["unit"]).first().ids


def test_blocks_that_repeat_and_blocks_that_change(spark):
    text = prose(3, 60)
    docs = documents(spark, [(7, text)] * 40).repartition(4)
    found = pieces.encoded(docs, block_bytes=100).collect()
    assert [(r.doc_id, r.ids) for r in found] == [(7, LIBRARY.encode(text))] * 40
    changing = F.udf(lambda t: f"{t} {time.time_ns()}").asNondeterministic()
    random_order = documents(spark, [(i, prose(i, 9)) for i in range(30)]).withColumn("text", changing("text"))
    with pytest.raises(Exception, match="store them first"):
        pieces.encoded(random_order).collect()


def test_session_settings_are_left_as_they_were(spark):
    name = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(name)
    pieces.encoded(documents(spark, {1: "a"})).collect()
    assert spark.conf.get(name) == before


def cut(texts, joins):
    """Each text's units, as _cut finds them, and the distinct ones."""
    ends, codes, units = pieces._cut(pa.array(texts, pa.large_string()), joins)
    names = [u.decode().replace(" ", pieces.BLANK) for u in units.to_pylist()]
    return [[names[i] for i in codes[a:b]] for a, b in zip([0, *ends], ends)], names


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abehnorstxéß ▁\n\t中あ🙂.,;$%19-\x00"), max_size=40), max_size=4))
def test_units_end_only_where_no_merge_passes(texts):
    long = pieces.LongUnits(LOADED)
    for text, units in zip(texts, cut(texts, LOADED.joins())[0]):
        assert "".join(units) == "".join(pieces.units_of(text))
        assert [i for u in units for i in long.ids(u)] == LIBRARY.encode(text)


def test_words_that_meet_without_a_blank_are_units_of_their_own():
    words = sorted({w.lower() for w in prose(5, 400).split() if w.isalpha()})[:30]
    texts = [f"{a}.\n{b},{i}%{j}" for i, a in enumerate(words) for j, b in enumerate(words)]
    units = cut(texts, LOADED.joins())[1]
    assert len(units) <= 2 * len(words) + 20
    assert not any("\n" in u and len(u) > 1 for u in units)


def test_units_of_a_unigram_model_end_at_blanks():
    texts = [t or "" for t in TEXTS]
    own = pieces.Pieces(["▁", "a"], [-1.0, -2.0], [True, True], 0, False)
    assert cut(texts, own.joins())[0] == [pieces.units_of(t) for t in texts]


def test_counts_of_ids_in_bytes():
    sizes = np.array([0, 1, 254, 255, 256, 509, 510, 511, 70_000, 0, 3])
    rows = pieces._counted(sizes, np.array([0, 4, 4, 11])).to_pylist()
    assert [list(pieces._sizes(r)) for r in rows] == [list(sizes[:4]), [], list(sizes[4:])]


def test_text_that_is_no_utf8(spark):
    raw = [b"a\xff b", b"\xc3", b"x \xe2\x96 y", "▁ é".encode()]
    docs = spark.createDataFrame([(i, bytearray(b)) for i, b in enumerate(raw)], "doc_id long, text binary")
    found = pieces.encoded(docs.withColumn("text", F.col("text").cast("string"))).collect()
    assert {r.doc_id: r.ids for r in found} == {i: LIBRARY.encode(b.decode("utf-8", "replace")) for i, b in enumerate(raw)}
