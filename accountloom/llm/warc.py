"""WARC archives as a table of chunks.

A record whose payload is longer than a chunk is written in segments, as the format
provides: the first under its own type, the others as `continuation` records. One
segment is one row, written by Spark's text writer and read back by splitting files
at the version line, so neither side needs a whole record at once. A payload that
contains the version line is cut inside it, which keeps it from being taken for the
start of a record. Writer and reader carry digests from chunk to chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.llm.common import prepare, stored

NAME = "WARC/1.1"
VERSION = f"{NAME}\r\n"
CHUNK = 32 * 1024
MIN_REVISIT = 100
NO_DATE = "1970-01-01T00:00:00Z"


def _header_safe(text: Column) -> Column:
    """Text that fits on a header line: control characters and blanks become %20.

    A blank, which readers drop, keeps an end of line from completing the version line.
    """
    safe = F.regexp_replace(text, "[\\x00-\\x20\\x7F]", "%20")
    return F.when(safe.endswith(NAME), F.concat(safe, F.lit(" "))).otherwise(safe)


def pieces(payload: memoryview, chunk: int) -> Iterator[memoryview]:
    """The payload in pieces of at most chunk bytes, at least one.

    None holds the version line, and none ends in the version's name, which the line end
    written after it would complete.
    """
    name, line = NAME.encode(), VERSION.encode()
    at, size = 0, len(payload)
    while True:
        end = min(at + chunk, size)
        piece = bytes(payload[at:end])
        if (found := piece.find(line)) >= 0:
            end = at + found + 4
        elif piece.endswith(name):
            end -= 4
        yield payload[at:end]
        at = end
        if at >= size:
            return


_CHUNKS = (
    "record_id string, page_id long, url string, chunk_no int, chunk binary, "
    "running_digest string, running_size long, last boolean"
)
_CHUNK_TYPES = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.string(), pa.int64(), pa.bool_()]
CHUNKS_AT_ONCE = 64


def chunk_table(pages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows (record_id, page_id, url, chunk_no, chunk, running_digest, running_size, last) of pages.

    Each payload is passed over once, and the digest carried from chunk to chunk; a task
    holds some chunks beside the batch that it reads. url is in a record's first row only.
    """
    names = [x.split()[0] for x in _CHUNKS.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), _CHUNK_TYPES)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = TaskContext.get().partitionId() << 33, []
        for batch in batches:
            html = batch.column("html")
            for i, (page_id, url) in enumerate(zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist())):
                payload = memoryview(html[i].as_buffer() if html[i].is_valid else b"")
                record_id = f"urn:page:{'null' if page_id is None else page_id}#{number}"
                digest, size = hashlib.sha256(), 0
                for n, piece in enumerate(pieces(payload, chunk)):
                    digest.update(piece)
                    size += len(piece)
                    last = size == len(payload)
                    rows.append((record_id, page_id, None if n else url, n, bytes(piece), digest.hexdigest(), size, last))
                    if len(rows) >= CHUNKS_AT_ONCE:
                        yield batch_of(rows)
                        rows = []
                number += 1
        if rows:
            yield batch_of(rows)

    columns = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.col("html").cast("binary").alias("html"))
    return columns.mapInArrow(run, _CHUNKS)


def decided(chunks: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """The chunks to write, with chunks, digest, size, record_type and refers_to of their record.

    A record of one chunk carries its own digest. Only the chunks of larger ones are
    joined to what their last chunk says. A revisit has one empty chunk; its payload is
    that of the record it refers to.
    """
    whole = F.col("running_digest").alias("digest"), F.col("running_size").alias("size")
    ends = chunks.filter("last").select("record_id", "page_id", F.col("chunk_no").alias("_last"), *whole)
    repeated = (
        ends.filter(F.col("size") >= min_revisit)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    repeated = stored(repeated, "repeated")
    one = chunks.filter("last AND chunk_no = 0").select(
        "record_id", "page_id", "url", "chunk_no", "chunk", F.lit(0).alias("_last"), *whole
    )
    facts = ends.filter("_last > 0").select("record_id", "_last", "digest", "size").join(repeated, "digest", "left")
    parts = chunks.filter("NOT (last AND chunk_no = 0)").select("record_id", "page_id", "url", "chunk_no", "chunk")
    several = parts.join(stored(facts, "large-records"), "record_id")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (
        one.join(repeated, "digest", "left")
        .unionByName(several)
        .withColumn("_revisit", revisit)
        .filter("NOT (_revisit AND chunk_no > 0)")
        .select(
            "record_id", "page_id", "url", "digest", "size", "chunk_no",
            F.when(F.col("_revisit"), "revisit").otherwise("response").alias("record_type"),
            F.when(F.col("_revisit"), F.col("first")).alias("refers_to"),
            F.when(F.col("_revisit"), 1).otherwise(F.col("_last") + 1).alias("chunks"),
            F.when(F.col("_revisit"), F.lit("").cast("binary")).otherwise(F.col("chunk")).alias("chunk"),
        )
    )


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _segment(date: str) -> Column:
    """A chunk row as the text of its WARC record, without the two line ends that close it."""
    first, segmented = F.col("chunk_no") == 0, F.col("chunks") > 1
    last = segmented & (F.col("chunk_no") == F.col("chunks") - 1)
    own = F.when(first, F.col("record_id")).otherwise(F.concat("record_id", F.lit("/"), F.col("chunk_no") + 1))
    head = F.concat(
        F.lit(VERSION),
        _line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), own, F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.when(first, _header_safe(F.col("url")))),
        _line("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha256:"), F.col("digest")))),
        _line("WARC-Payload-Length", F.when(first, F.col("size").cast("string"))),
        _line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        _line("WARC-Segment-Origin-ID", F.when(~first, F.concat(F.lit("<"), F.col("record_id"), F.lit(">")))),
        _line("WARC-Segment-Number", F.when(segmented, (F.col("chunk_no") + 1).cast("string"))),
        _line("WARC-Segment-Total-Length", F.when(last, F.col("size").cast("string"))),
        _line("Content-Length", F.octet_length("chunk").cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(head.cast("binary"), F.col("chunk")).cast("string")


def write_archives(
    pages: DataFrame,
    path: str,
    chunk: int = CHUNK,
    min_revisit: int = MIN_REVISIT,
    date: str = NO_DATE,
    compression: str = "gzip",
) -> None:
    """Write one WARC record per row of pages (page_id, url, html) under the path.

    Of records with equal payloads of at least min_revisit bytes, that with the smallest
    page_id is a response and the others revisit it; rows without an id come last, and
    all are responses if no equal row has an id. Rows that repeat the smallest id are
    all responses. A null html is an empty payload, a null url has no header. Other
    columns are ignored; an empty table gives archives without records.
    """
    prepare(pages.sparkSession)
    chunks = stored(chunk_table(pages, chunk), "chunks")
    rows = decided(chunks, min_revisit).select(_segment(date).alias("value"))
    rows.write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives under the path, one row per segment.

    A record that is cut short or holds the version line in one piece raises an error
    when the rows are used.
    """
    prepare(spark)
    pieces = spark.read.option("lineSep", VERSION).text(path).filter(F.octet_length("value") > 0)
    head = F.substring_index("value", "\r\n\r\n", 1)

    def field(name: str) -> Column:
        found = F.regexp_extract("head", f"(?:\\A|\r\n){name}: ([^\r\n]*)", 1)
        return F.when(found != "", found)

    def bare(name: str) -> Column:
        return F.regexp_extract(F.coalesce(field(name), F.lit("")), "<(.*)>", 1)

    length = field("Content-Length").cast("int")
    found = pieces.select("value", head.alias("head")).select(
        field("WARC-Type").alias("type"),
        bare("WARC-Record-ID").alias("own_id"),
        bare("WARC-Segment-Origin-ID").alias("origin"),
        F.rtrim(field("WARC-Target-URI")).alias("url"),
        F.regexp_extract(F.coalesce(field("WARC-Payload-Digest"), F.lit("")), "sha256:(.*)", 1).alias("stated_digest"),
        field("WARC-Payload-Length").cast("long").alias("stated_size"),
        F.nullif(bare("WARC-Refers-To"), F.lit("")).alias("refers_to"),
        F.coalesce(field("WARC-Segment-Number").cast("int"), F.lit(1)).alias("segment"),
        field("WARC-Segment-Number").isNotNull().alias("segmented"),
        length.alias("length"),
        F.substring(F.col("value").cast("binary"), F.octet_length("head") + 5, length).alias("chunk"),
        (F.octet_length("value") - F.octet_length("head") - 8).alias("present"),
    )
    whole = F.assert_true(F.col("present") == F.col("length"), F.concat(F.lit("damaged WARC record "), F.col("own_id")))
    return found.select(
        F.when(F.col("origin") == "", F.col("own_id")).otherwise(F.col("origin")).alias("record_id"),
        (F.col("segment") - 1).alias("chunk_no"),
        "segmented", "type", "url", "stated_digest", "stated_size", "refers_to",
        F.when(whole.isNull(), F.col("chunk")).alias("chunk"),
    )


_DIGESTED = (
    "record_id string, type string, url string, stated_digest string, stated_size long, "
    "refers_to string, payload_bytes long, payload_digest string"
)


def _carried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record out of chunk rows in order; only the running digest is kept."""
    current, head, digest, size = None, None, None, 0
    kinds = dict(x.split() for x in _DIGESTED.split(", "))
    names = list(kinds)
    types = [pa.int64() if k == "long" else pa.string() for k in kinds.values()]

    def close() -> list:
        return [current, *head, size, digest.hexdigest()]

    def out(done: list) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*done), types)]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in batches:
        done = []
        for row in batch.to_pylist():
            if row["record_id"] != current:
                if current is not None:
                    done.append(close())
                current, digest, size = row["record_id"], hashlib.sha256(), 0
                head = [row[n] for n in names[1:6]]
            digest.update(row["chunk"])
            size += len(row["chunk"])
        if done:
            yield out(done)
    if current is not None:
        yield out([close()])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: its header fields, and size and digest computed from its chunks.

    Records of one chunk are digested where they are read. The chunks of others meet
    in order in one task per record, which holds a batch of chunks at a time. A revisit
    has the size and digest that it states; a response whose chunks do not give what it
    states raises an error.
    """
    chunks = read_chunks(spark, path)
    one = chunks.filter("NOT segmented").select(
        "record_id", "type", "url", "stated_digest", "stated_size", "refers_to",
        F.octet_length("chunk").cast("long").alias("payload_bytes"),
        F.sha2("chunk", 256).alias("payload_digest"),
    )
    ordered = (
        chunks.filter("segmented").repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    )
    records = one.unionByName(ordered.mapInArrow(_carried, _DIGESTED))
    revisit = F.col("type") == "revisit"
    agrees = (F.col("payload_digest") == F.col("stated_digest")) & (F.col("payload_bytes") == F.col("stated_size"))
    checked = F.assert_true(revisit | agrees, F.concat(F.lit("digest of WARC record "), F.col("record_id")))
    return records.select(
        "record_id",
        F.regexp_extract("record_id", "^urn:page:(\\d+|-\\d+)#", 1).try_cast("long").alias("page_id"),
        "url",
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("stated_size")).when(checked.isNull(), F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.regexp_extract("refers_to", "^urn:page:(.*)$", 1).try_cast("long").alias("refers_to"),
    )
