from __future__ import annotations

import hashlib
import random
import re

import pytest

from accountloom.llm import winnowing
from accountloom.llm.queries import op13_decontamination
from tests.llm.support import SF, clashing, documents, prose

ASCII = str.maketrans(winnowing.UPPER, winnowing.LOWER)


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(ASCII))


def plain(docs: list[tuple], items: list[tuple], window=10):
    """(id, words, hit words, digest of the items, hit) of each row, by looking up every run of words."""
    known: dict[tuple, set] = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            known.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in known}:
            for at in range(len(w) - n + 1):
                if items_of := known.get(tuple(w[at : at + n])):
                    hit |= set(range(at, at + n))
                    found |= items_of
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=str)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def answer(spark, docs, items):
    found = winnowing.counted(winnowing.contaminated(docs, benchmark(spark, items)))
    return sorted((tuple(r) for r in found.collect()), key=str)


def cases():
    a, b, c = (prose(s, 30) for s in (1, 2, 3))
    items = [(1, a), (2, b), (3, b.upper()), (3, c), (10, a), (7, None), (8, "  ...  "), (None, prose(4, 12))]
    part = lambda t, i, j: " ".join(t.split()[i:j])
    docs = [(i, f"{prose(i + 50, 40)} {part(a, i, i + 10)} {prose(i + 90, 30)}") for i in range(0, 20, 3)]
    docs += [(100 + i, f"{prose(i, 9)} {part(b, 3, 3 + 8 + i)} {prose(i + 5, 9)}") for i in range(5)]
    docs += [(200, a + b), (201, b.title() + "!" + c.replace(" ", " -- ")), (202, part(a, 0, 9)), (203, prose(4, 12))]
    docs += [(300, None), (301, ""), (302, "... !"), (None, a), (None, a), (400, c), (400, c), (401, "a " * 500)]
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    assert answer(spark, clashing(documents(spark, docs)), items) == plain(docs, items)


def test_short_items_hit_everywhere(spark):
    docs, items = cases()
    short = [(20 + n, " ".join(prose(2, 30).split()[5 : 5 + n])) for n in (1, 2, 4, 7, 9)]
    docs.append((500, "word"))
    assert answer(spark, documents(spark, docs), items + short) == plain(docs, items + short)
    assert answer(spark, documents(spark, docs), short[:1]) == plain(docs, short[:1])


def test_only_ascii_letters_lose_their_case(spark):
    text = "É Ñandú straße İstanbul ΑΣ 12 ab ÀB ﬁ K x"
    items = [(1, text)]
    docs = [(1, text), (2, text.replace("É", "é")), (3, text.replace("K", "k")), (4, text.replace("ab", "AB"))]
    docs += [(5, text.replace("Σ", "ς")), (6, text.replace(" ", "\x7f\x00_")), (7, text + "é")]
    assert answer(spark, documents(spark, docs), items) == plain(docs, items)


def test_spans_and_items(spark):
    a, b = prose(1, 30), prose(2, 12)
    docs = documents(spark, {1: f"x y {a} z {b}", 2: "nothing"})
    found = {r.doc_id: r for r in winnowing.contaminated(docs, benchmark(spark, [(2, a), (10, b)])).collect()}
    assert [tuple(s) for s in found[1].spans] == [(2, 32), (33, 45)] and found[1]["items"] == ["10", "2"]
    assert found[2].spans == [] and found[2]["items"] == []


def test_empty_tables(spark):
    docs, items = cases()
    assert answer(spark, documents(spark, docs).limit(0), items) == []
    assert answer(spark, documents(spark, docs), []) == plain(docs, [])


@pytest.mark.parametrize("window, gram", [(5, 2), (6, 6), (8, 1)])
def test_other_sizes(spark, window, gram):
    rng = random.Random(window)
    text = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    docs, items = [(i, text(60)) for i in range(30)], [(i, text(rng.randint(1, 14))) for i in range(12)]
    found = winnowing.counted(
        winnowing.contaminated(documents(spark, docs), benchmark(spark, items), window, gram)
    )
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(docs, items, window)


def test_whole_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = sorted((tuple(r) for r in op13_decontamination(spark, SF).collect()), key=str)
    assert found == plain(docs, items) and any(r[-1] for r in found)


def test_no_python_runs(spark):
    found = winnowing.contaminated(documents(spark, {1: "a"}), benchmark(spark, [(1, "a")]))
    text = found._jdf.queryExecution().toString()
    assert not any(x in text for x in ("Python", "Pandas", "Arrow"))
