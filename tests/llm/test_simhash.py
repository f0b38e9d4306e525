from __future__ import annotations

import numpy as np
import pytest
import xxhash

from accountloom.llm import components as stars
from accountloom.llm import simhash
from accountloom.llm.components import components
from accountloom.llm.queries import op8_simhash
from accountloom.settings import setting
from tests.llm.support import SF, clashing, documents, prose


def plain_fingerprint(text, size=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints: dict, radius=2):
    ids = sorted(prints)
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= radius and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


def answer(df):
    return {r.doc_id: (r.fp % 2**64, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("text", ["", None, " \t\n", "one", "One TWO", "a b c d", "É é\x1cx  y", prose(1, 500)])
def test_fingerprint(text):
    assert simhash.fingerprint_of(text.encode() if text is not None else None) == plain_fingerprint(text)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = prose(2, 300)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 7)
    assert simhash.fingerprint_of(text.encode()) == plain_fingerprint(text)


def test_against_brute_force(spark):
    base = prose(3, 400)
    texts = {i: prose(i, 60) for i in range(10, 40)}
    texts |= {100 + i: base + f" w{i}" for i in range(12)} | {50: None, 51: "", 52: "  ", 7: base}
    texts |= {60: texts[10], 61: texts[10]}
    found = answer(simhash.near_duplicates(clashing(documents(spark, texts)), tile=4))
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    labels = plain_components(prints)
    assert found == {i: (prints[i], labels[i]) for i in texts}
    assert found[50][1] == found[51][1] == 50 and found[61][1] == 10


def test_registered_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    labels = plain_components(prints)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in op8_simhash(spark, SF).collect()}
    assert found == {i: (f"{prints[i]:016x}", labels[i]) for i in prints}


def test_repeated_rows_null_ids_and_empty_table(spark):
    docs = documents(spark, [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "lone words of no one else")])
    found = simhash.near_duplicates(docs).select("doc_id", "component_id").collect()
    assert sorted(map(tuple, found), key=str) == [(1, 1), (1, 1), (None, 1), (None, None)]
    kept = simhash.one_per_group(docs).collect()
    assert [r.doc_id for r in kept if r.text == "a b c"] == [1, 1]
    assert [r.doc_id for r in kept if r.text != "a b c"] == [None]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_one_per_group_keeps_columns(spark):
    docs = clashing(documents(spark, {1: "x y z", 2: "x y z", 3: prose(5, 30)}))
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_tiles_miss_no_link_and_emit_no_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 5, dtype=np.uint64)
    near = [int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in rng.integers(0, 63, (60, 2))]
    prints = sorted({int(b) for b in base} | set(near))
    rows = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = simhash.links(rows, tile=16)
    assert edges.count() < 42 * len(prints)
    roots = {r.u: r.v for r in components(edges).collect()}
    wanted = plain_components({p: p for p in prints})
    assert {p: roots.get(p, p) for p in prints} == wanted


def test_components_of_a_path_a_hub_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    hub = [(1000, 1001 + i) for i in range(300)]
    rows = spark.createDataFrame(path + hub + [(7, 7), (5000, 5000), (None, 3)], "u long, v long")
    found = {r.u: r.v for r in components(rows).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {1001 + i: 1000 for i in range(300)}


def test_rounds_write_few_files_for_few_edges(spark, monkeypatch):
    files = []

    def stored(df, label, **options):
        out = simhash.stored(df, label, **options)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(stars, "stored", stored)
    rows = spark.createDataFrame([(i, i + 1) for i in range(200)], "u long, v long")
    with (
        setting(spark, "spark.sql.shuffle.partitions", "32"),
        setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"),
    ):
        found = {r.u: r.v for r in components(rows).collect()}
    assert found == {i: 0 for i in range(1, 201)}
    assert max(files[1:]) <= stars.LEAST_FILES
