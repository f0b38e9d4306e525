from __future__ import annotations

import gzip
import hashlib
import re

import duckdb
import pytest

from accountloom.llm import warc
from accountloom.llm.queries import llm_oracles, op2_warc
from accountloom.sources import files
from tests.llm.support import SF

PAGES = "page_id long, url string, html string, extra int, digest string, chunk string, record_id string, size int, last int"
LONG = "long page é " * 400


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, 1, "x", "y", "z", 2, 3) for i, u, h in rows], PAGES)


def written(spark, folder, rows, **options):
    path = f"{folder}/warc"
    warc.write_archives(pages(spark, rows), path, **options)
    return path


def expected(rows, least=100):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = len(data) >= least and (h or "") in first and first[h or ""] != i
        out.append(
            (i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None)
        )
    return sorted(out, key=str)


def answer(df):
    rows = df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(map(tuple, rows.collect()), key=str)


ROWS = [
    (1, "http://a/x", LONG),
    (2, "http://a/y", LONG),
    (3, None, None),
    (4, "http://b/\r\nWARC/1.1\r\n evil", ""),
    (5, "u", "short"),
    (6, "u", "short"),
    (7, "u", "WARC/1.1\r\n" * 40),
    (8, "u", "x" * 31 + "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"),
    (9, "u", "\r\n\r\n" * 50),
    (None, "u", LONG),
    (None, "u", "no other row has this text, which is longer than one hundred bytes; " * 2),
    (10, "u", "﻿😀" * 77),
]


@pytest.mark.parametrize("chunk", [1, 7, 64, 32 * 1024])
@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(spark, folder, chunk, compression):
    path = written(spark, folder, ROWS, chunk=chunk, compression=compression)
    assert answer(warc.read_records(spark, path)) == expected(ROWS)


@pytest.mark.parametrize("chunk", [3, 12, 64])
def test_payloads_and_chunks_that_end_in_the_version_line(spark, folder, chunk):
    line = "WARC/1.1\r\n"
    heads = [line[:n] for n in range(len(line) + 1)]
    rows = [(i, f"http://a/{h}", f"hello {h}") for i, h in enumerate(heads)]
    # Every part of the line at the end of a chunk, alone and twice, and in payloads that repeat.
    rows += [(100 + i, "u", "x" * (64 - len(h)) + h + "y" * 40) for i, h in enumerate(heads)]
    rows += [(200 + i, h, (h + line) * 30) for i, h in enumerate(heads)]
    rows += [(300 + i, None, (h + line) * 30) for i, h in enumerate(heads)]
    rows += [(400, "u", "WARC/1.1" * 50), (401, "u", "WARC" * 90 + "/1.1"), (402, "u", "WARC/1.WARC/1.1")]
    path = written(spark, folder, rows, chunk=chunk, compression="none")
    assert answer(warc.read_records(spark, path)) == expected(rows)
    urls = {r.page_id: r.url for r in warc.read_records(spark, path).collect()}
    assert urls[8] == "http://a/WARC/1.1" and urls[300] is None


def test_a_payload_of_many_chunks(spark, folder):
    rows = [(1, "u", "é0123456789" * 600_000), (2, "u", "é0123456789" * 600_000), (3, "u", "small")]
    path = written(spark, folder, rows)
    assert answer(warc.read_records(spark, path)) == expected(rows)
    chunks = warc.read_chunks(spark, path).filter("segmented").selectExpr("max(length(chunk)) AS n", "count(*) AS c").first()
    assert chunks.n == warc.CHUNK and chunks.c > 200


def test_running_digests(spark):
    rows = [(1, "u", "abcdefgh"), (2, "u", None)]
    found = sorted(warc.chunk_table(pages(spark, rows), 3).collect(), key=lambda r: (r.page_id, r.chunk_no))
    seen = [(r.page_id, r.chunk_no, bytes(r.chunk), r.running_size, r.last, r.url) for r in found]
    assert seen == [
        (1, 0, b"abc", 3, False, "u"), (1, 1, b"def", 6, False, None), (1, 2, b"gh", 8, True, None), (2, 0, b"", 0, True, "u"),
    ]
    assert [r.running_digest for r in found[:3]] == [hashlib.sha256(b"abcdefgh"[:n]).hexdigest() for n in (3, 6, 8)]


def test_payloads_can_be_put_together_again(spark, folder):
    path = written(spark, folder, ROWS, chunk=50)
    chunks = warc.read_chunks(spark, path).collect()
    by = {}
    for c in sorted(chunks, key=lambda c: (c.record_id, c.chunk_no)):
        by[c.record_id] = by.get(c.record_id, b"") + bytes(c.chunk)
    digests = {hashlib.sha256(x).hexdigest() for x in by.values()}
    assert digests >= {hashlib.sha256((h or "").encode()).hexdigest() for _, _, h in ROWS}
    assert max(len(c.chunk) for c in chunks) <= 50


def test_repeated_rows_are_all_responses(spark, folder):
    rows = [(1, "u", LONG), (1, "u", LONG), (2, "u", LONG)]
    found = answer(warc.read_records(spark, written(spark, folder, rows, chunk=100)))
    assert [r[3] for r in found] == ["response", "response", "revisit"]


def test_empty_table(spark, folder):
    path = f"{folder}/warc"
    warc.write_archives(pages(spark, ROWS).limit(0), path)
    assert warc.read_records(spark, path).collect() == []


def test_files_are_warc(spark, folder):
    """Parsed without this package: every record's length leads to the next record."""
    path = written(spark, folder, ROWS, chunk=40)
    types = []
    for name in files.names(spark, path):
        if not name.endswith(".gz"):
            continue
        data = gzip.open(f"{path.removeprefix('file:')}/{name}").read()
        at = 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = data[at:end].decode()
            assert head.startswith("WARC/1.1\r\nWARC-Type: ")
            assert "WARC-Record-ID: <urn:page:" in head and "WARC-Date: " in head
            length = int(re.search(r"Content-Length: (\d+)", head)[1])
            types.append(re.search(r"WARC-Type: (\w+)", head)[1])
            at = end + 4 + length
            assert data[at : at + 4] == b"\r\n\r\n"
            at += 4
    assert types.count("response") == 10 and types.count("revisit") == 2 and "continuation" in types


def test_damage_is_found(spark, folder):
    path = written(spark, folder, [(1, "u", LONG)], chunk=100, compression="none")
    text = spark.read.option("lineSep", "\0").text(path).first()[0]
    for spoilt in (text.replace("page", "pane", 1), text[:-9], text.replace("Content-Length: 100", "Content-Length: 90", 1)):
        bad = f"{folder}/bad-{abs(hash(spoilt))}"
        spark.createDataFrame([(spoilt,)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(bad)
        with pytest.raises(Exception, match="WARC record"):
            warc.read_records(spark, bad).collect()


def test_registered_query(spark):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    df = op2_warc(spark, SF)
    wanted = duck.sql(llm_oracles()["op2_warc"]).select(*df.columns).fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(wanted, key=str)
