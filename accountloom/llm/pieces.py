"""SentencePiece encoding and decoding as relations.

A text is units: a word with the blanks before it, for a byte-pair model cut further
wherever no piece holds the two bytes that meet there. No merge passes such a place, so what
lies on one side has the same ids whatever lies on the other. Each distinct unit is a lattice:
its substrings of bounded length are exploded and joined to the piece table, the edges
found are grouped by unit, and a higher-order aggregate folds them to the unit's
segmentation. For a unigram model the fold is Viterbi's: the best sum of scores up to
each place. The given vocabulary is a byte-pair model, for which that sum gives other
ids than its own encoder. Its fold merges, in order of score and place, each edge that
spans just two pieces by then; a trained byte-pair piece has a lower score than the pieces
that it is merged from, so one pass over the edges meets them all in time. The state is one
number, a bit for each place where a piece starts. Units that hold a piece of which this
is not so (runs of blanks, which no training merged) are left to the task that gathers the
ids, as very long units are. Characters without a piece fall back to bytes.

Documents are read twice, in the same blocks, which go by their content. The first time a
block sends its distinct units, one row per bucket; the second time it meets their ids,
in the same order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from accountloom.llm.arrays import let
from accountloom.llm.blocks import LEAST_BUCKETS, buckets_of, slices
from accountloom.llm.common import prepare

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BLANK = "▁"
# So much text has at most some 260,000 distinct units, whose edges a task groups.
BUCKET_BYTES = 2 * 1024 * 1024
BLOCK_BYTES = 8 * 1024 * 1024
# A place, also that after the last, has a bit of a positive 64-bit number; longer units are segmented by a loop in the task.
LONGEST_FOLDED = 60


@dataclass
class Pieces:
    """A model's pieces in order of id, with their scores; first_byte is the id of byte 0."""

    names: list[str]
    scores: list[float]
    normal: list[bool]
    first_byte: int
    merges: bool

    @classmethod
    def load(cls, model: str = MODEL, merges: bool = True) -> Pieces:
        found = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(found.get_piece_size())
        special = [found.is_control(i) or found.is_unknown(i) or found.is_unused(i) for i in ids]
        is_byte = [found.is_byte(i) for i in ids]
        return cls(
            [found.id_to_piece(i) for i in ids],
            [found.get_score(i) for i in ids],
            [not a and not b for a, b in zip(special, is_byte)],
            is_byte.index(True),
            merges,
        )

    @property
    def longest(self) -> int:
        return max(len(n) for n, ok in zip(self.names, self.normal) if ok)

    def joins(self) -> np.ndarray:
        """Whether a unit goes on from one byte to the next, by both as one number; a blank counts as a space.

        A byte-pair model's units end where no piece holds both, any other's at a blank after a word.
        """
        told = np.full((256, 256), not self.merges)
        if self.merges:
            names = [n.replace(BLANK, " ").encode() for n, ok in zip(self.names, self.normal) if ok]
            data = np.frombuffer(b"\xff".join(names), np.uint8)
            told[data[:-1], data[1:]] = True
        else:
            told[:, ord(" ")] = np.arange(256) == ord(" ")
        told[:, 0x80:0xC0] = True  # no character is cut
        return told.reshape(-1)

    def table(self, spark: SparkSession) -> DataFrame:
        """Rows (piece, id, score, rank, odd); as many as the vocabulary has, whatever the corpus.

        An odd piece of a byte-pair model comes about by a merge before which one of no
        higher score is needed.
        """
        long = LongUnits(self)
        odd = lambda n: self.merges and not long.falls(n)
        if len(self.names) >= 1 << ID_BITS:
            raise ValueError(f"at most {(1 << ID_BITS) - 1} pieces have a place in an edge")
        rank = {s: r for r, s in enumerate(sorted(set(self.scores), reverse=True))}
        rows = [
            (n, i, s, rank[s], odd(n)) for i, (n, s, ok) in enumerate(zip(self.names, self.scores, self.normal)) if ok
        ]
        return spark.createDataFrame(rows, "piece string, id int, score double, rank int, odd boolean")


def units_of(text: str) -> list[str]:
    """The words of a text, each with the blanks before it; a blank is put before the first."""
    if not text:
        return []
    words = text.split(" ")
    if "" not in words and BLANK not in text:
        return [BLANK + w for w in words]
    out, blanks = [], ""
    for word in text.replace(BLANK, " ").split(" "):
        blanks += BLANK
        if word:
            out.append(blanks + word)
            blanks = ""
    return out + [blanks] if blanks else out


def _found(units: DataFrame, table: DataFrame, longest: int, keys: list[str]) -> DataFrame:
    """A row for every piece in the column unit: keys, start, size and the piece's columns.

    Places count from 1. A character without a piece has a row of nulls.
    """
    size = F.length("unit")
    starts = units.select(*keys, F.explode(F.sequence(F.lit(1), size)).alias("start"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(longest), size - F.col("start") + 1))
    spans = starts.select(*keys, "start", F.explode(sizes).alias("size"))
    parts = spans.withColumn("piece", F.substring("unit", F.col("start"), F.col("size")))
    return parts.join(F.broadcast(table), "piece", "left").filter("size = 1 OR id IS NOT NULL")


def edges(units: DataFrame, table: DataFrame, longest: int, keys: list[str]) -> DataFrame:
    """keys and edges: array of (start, size, score, id) of every piece in the column unit."""
    edge = F.struct("start", "size", "score", "id")
    return _found(units, table, longest, keys).groupBy(*keys).agg(F.collect_list(edge).alias("edges"))


# An edge of a byte-pair lattice is one number: whether its piece is odd, the rank of its
# score, its start, its size, and its id + 1 (0 for a character without a piece).
ID_BITS, PLACE_BITS, RANK_BITS = 18, 6, 20
_SIZE, _START, _RANK = ID_BITS, ID_BITS + PLACE_BITS, ID_BITS + 2 * PLACE_BITS
ODD = 1 << (_RANK + RANK_BITS)


def _shifted(value: Column | int, bits: Column | int) -> Column:
    value = F.lit(value) if isinstance(value, int) else value
    return F.call_function("shiftleft", value.cast("long"), F.lit(bits) if isinstance(bits, int) else bits)


def _field(edge: Column, at: int, bits: int) -> Column:
    return F.shiftright(edge, at).bitwiseAND(F.lit((1 << bits) - 1).cast("long")).cast("int")


def packed_edges(units: DataFrame, table: DataFrame, longest: int, keys: list[str]) -> DataFrame:
    """keys and edges: an array of packed edges, of every piece in the column unit."""
    rank, piece = F.coalesce("rank", F.lit((1 << RANK_BITS) - 1)), F.coalesce(F.col("id") + 1, F.lit(0))
    edge = _shifted(rank, _RANK) + _shifted(F.col("start"), _START) + _shifted(F.col("size"), _SIZE) + piece
    whole = edge + F.when(F.col("odd"), F.lit(ODD)).otherwise(0)
    return _found(units, table, longest, keys).groupBy(*keys).agg(F.collect_list(whole).alias("edges"))


def merged_ids(unit: Column, found: Column, first_byte: int) -> Column:
    """The ids of a byte-pair segmentation, from packed edges."""

    def places(e: Column) -> tuple[Column, Column]:
        """The bits of an edge's two ends, and those of the places inside it."""
        start = _field(e, _START, PLACE_BITS)
        first, last = _shifted(1, start), _shifted(1, start + _field(e, _SIZE, PLACE_BITS))
        return first + last, last - first * 2

    def merge(starts: Column, e: Column) -> Column:
        ends, inside = places(e)
        two = (starts.bitwiseAND(ends) == ends) & (F.bit_count(starts.bitwiseAND(inside)) == 1)
        return F.when(two, starts.bitwiseAND(F.bitwise_not(inside))).otherwise(starts)

    def is_piece(starts: Column, e: Column) -> Column:
        ends, inside = places(e)
        return starts.bitwiseAND(ends + inside) == ends

    def by_place(e: Column) -> Column:
        return _shifted(_field(e, _START, PLACE_BITS), _START) + _field(e, 0, ID_BITS)

    def ids(kept: Column) -> Column:
        piece = lambda e: _field(e, 0, ID_BITS) - 1
        known = F.forall(kept, lambda e: piece(e) >= 0)
        mixed = F.transform(
            kept, lambda e: _piece_or_bytes(unit, _field(e, _START, PLACE_BITS), F.nullif(piece(e), F.lit(-1)), first_byte)
        )
        return F.when(known, F.transform(kept, piece)).otherwise(F.flatten(mixed))

    whole = _shifted(1, F.length(unit) + 2) - 2
    longer = F.sort_array(F.filter(found, lambda e: _field(e, _SIZE, PLACE_BITS) > 1))
    kept = lambda starts: F.sort_array(F.transform(F.filter(found, lambda e: is_piece(starts, e)), by_place))
    return let(F.aggregate(longer, whole, merge), lambda starts: let(kept(starts), ids))


def viterbi(found: Column, size: Column, unknown: float) -> Column:
    """The same for the segmentation with the best sum of scores; unknown is a byte fallback's score.

    The state holds, for each place, the best sum of scores up to it and where its last
    piece starts; of equal sums the longest last piece wins.
    """
    start = F.array(F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("from")))

    def reach(state: Column, end: Column) -> Column:
        arriving = F.filter(found, lambda e: e["start"] + e["size"] == end + 1)
        sums = F.transform(
            arriving,
            lambda e: F.struct(
                (F.get(state, e["start"] - 1)["sum"] + F.coalesce(e["score"], F.lit(unknown))).alias("sum"),
                (-e["start"]).alias("from"),
            ),
        )
        best = F.array_max(sums)
        return F.concat(state, F.array(F.struct(best["sum"].alias("sum"), (-best["from"]).alias("from"))))

    def back(state: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), size),
            F.array(size + 1),
            lambda places, _: F.when(F.get(places, F.lit(0)) == 1, places).otherwise(
                F.concat(F.array(F.get(state, F.get(places, F.lit(0)) - 1)["from"]), places)
            ),
        )

    return let(F.aggregate(F.sequence(F.lit(1), size), start, reach), back)


def _piece_or_bytes(unit: Column, at: Column, piece: Column, first_byte: int) -> Column:
    digits = F.hex(F.substring(unit, at, F.lit(1)).cast("binary"))
    single = F.transform(
        F.sequence(F.lit(0), (F.length(digits) / 2).cast("int") - 1),
        lambda i: F.conv(F.substring(digits, (2 * i + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + first_byte,
    )
    return F.when(piece.isNull(), single).otherwise(F.array(piece))


def _ids(unit: Column, found: Column, bounds: Column, first_byte: int) -> Column:
    def one(at: Column, i: Column) -> Column:
        size = F.get(bounds, i + 1) - at
        edge = F.get(F.filter(found, lambda e: (e["start"] == at) & (e["size"] == size)), F.lit(0))
        return _piece_or_bytes(unit, at, edge["id"], first_byte)

    return F.flatten(F.transform(F.slice(bounds, 1, F.size(bounds) - 1), one))


def _unknown(pieces: Pieces) -> float:
    return min(s for s, ok in zip(pieces.scores, pieces.normal) if ok) - 10.0


def encoded_units(units: DataFrame, pieces: Pieces, keys: list[str]) -> DataFrame:
    """keys and ids of every row; keys include unit, rows must be distinct in them.

    A byte-pair unit has at most LONGEST_FOLDED characters; one with an odd piece gives no row.
    """
    table, unit, lattice = pieces.table(units.sparkSession), F.col("unit"), F.col("edges")
    if pieces.merges:
        found = packed_edges(units, table, pieces.longest, keys).filter(F.array_max("edges") < ODD)
        ids = merged_ids(unit, lattice, pieces.first_byte)
    else:
        found = edges(units, table, pieces.longest, keys)
        ids = let(viterbi(lattice, F.length(unit), _unknown(pieces)), lambda bounds: _ids(unit, lattice, bounds, pieces.first_byte))
    return found.select(*keys, ids.alias("ids"))


class LongUnits:
    """The same segmentations for units too long for the fold."""

    def __init__(self, pieces: Pieces):
        rows = zip(pieces.names, pieces.scores, pieces.normal)
        self._known = {n: (s, i) for i, (n, s, ok) in enumerate(rows) if ok}
        self._first_byte = pieces.first_byte
        self._segment = self._merged if pieces.merges else self._best_sum
        self._longest, self._unknown = pieces.longest, _unknown(pieces)

    def ids(self, unit: str) -> list[int]:
        out: list[int] = []
        for part in self._segment(unit):
            if part in self._known:
                out.append(self._known[part][1])
            else:
                out += [self._first_byte + x for x in part.encode()]
        return out

    def _best_sum(self, unit: str) -> list[str]:
        best: list[tuple[float, int]] = [(0.0, 0)]
        for end in range(1, len(unit) + 1):
            arriving = []
            for start in range(max(0, end - self._longest), end):
                score = self._known.get(unit[start:end], (None,))[0]
                if score is not None or end - start == 1:
                    arriving.append((best[start][0] + (self._unknown if score is None else score), -start))
            total, start = max(arriving)
            best.append((total, -start))
        parts, end = [], len(unit)
        while end:
            parts.append(unit[best[end][1] : end])
            end = best[end][1]
        return parts[::-1]

    def falls(self, unit: str) -> bool:
        """Whether the merges of a unit come in order of falling score, equal ones to one piece."""
        seen: list[tuple[float, str]] = []
        self._merged(unit, seen)
        return all(a[0] > b[0] or a == b for a, b in zip(seen, seen[1:]))

    def _merged(self, unit: str, seen: list[tuple[float, str]] | None = None) -> list[str]:
        parts: list[str | None] = list(unit)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        waiting: list[tuple] = []

        def offer(a: int) -> None:
            b = after[a] if a >= 0 else len(parts)
            if a >= 0 and b < len(parts):
                both = parts[a] + parts[b]
                if both in self._known:
                    heapq.heappush(waiting, (-self._known[both][0], a, b, both))

        for a in range(len(parts) - 1):
            offer(a)
        while waiting:
            _, a, b, both = heapq.heappop(waiting)
            if parts[a] is None or after[a] != b or parts[b] is None or parts[a] + parts[b] != both:
                continue
            if seen is not None:
                seen.append((self._known[both][0], both))
            parts[a], parts[b] = both, None
            after[a] = after[b]
            if after[a] < len(parts):
                before[after[a]] = a
            offer(before[a])
            offer(a)
        return [part for part in parts if part is not None]


def _spans(strings: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings start, with the end of the last, and their bytes."""
    held = strings.combine_chunks() if isinstance(strings, pa.ChunkedArray) else strings
    held = held.cast(pa.large_binary())
    if not len(held):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, starts, data = held.buffers()
    starts = np.frombuffer(starts, np.int64)[held.offset : held.offset + len(held) + 1]
    return starts - starts[0], np.frombuffer(data or b"", np.uint8)[starts[0] : starts[-1]]


def _strings(starts: np.ndarray, data: np.ndarray) -> pa.Array:
    starts = np.ascontiguousarray(starts, np.int64)
    buffers = [None, pa.py_buffer(starts), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, buffers)


def _cut(texts: pa.Array, joins: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Where each text's units end, the units as numbers, and the distinct units by number; blanks are spaces."""
    none, blank = (pa.scalar(s, pa.large_string()) for s in ("", " "))
    led = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(blank, texts, none))
    if pc.any(pc.match_substring(led, BLANK)).as_py():
        led = pc.replace_substring(led, BLANK, " ")
    bounds, data = _spans(led)
    begins = np.ones(len(data) + 1, bool)
    pairs = data[:-1].astype(np.uint16) << 8 | data[1:]
    np.logical_not(joins[pairs], out=begins[1 : len(data)])
    begins[bounds] = True
    starts = np.flatnonzero(begins)
    coded = _strings(starts, data).dictionary_encode()
    return np.searchsorted(starts, bounds[1:]), coded.indices.to_numpy(), coded.dictionary


# Ends a unit among others; no text in UTF-8 holds this byte.
END = 0xFF


def _asked(units: pa.Array, buckets: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The units' numbers in the order in which they are sent, and each bucket's share of them."""
    hashes = np.array([xxhash.xxh64_intdigest(u) for u in units.to_pylist()], np.uint64)
    order = np.argsort(hashes, kind="stable")
    return order, slices(buckets_of(hashes[order], buckets).astype(np.int64))


def _sent(rows: pa.Table) -> tuple[np.ndarray, pa.Array]:
    """Where each row's units start, with the end of the last, and the units."""
    bounds, data = _spans(rows.column("units"))
    ends = data == END
    stops = np.flatnonzero(ends) + 1
    starts = np.r_[0, stops - np.arange(1, len(stops) + 1)]
    return np.searchsorted(stops, bounds, side="right"), _strings(starts, data[~ends])


def _counted(sizes: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A string per row with the sizes in its bounds: a byte each, after a byte 255 for every 255."""
    each = sizes // 255 + 1
    stops = np.r_[0, np.cumsum(each)]
    out = np.full(stops[-1], 255, np.uint8)
    out[stops[1:] - 1] = sizes % 255
    return _strings(stops[bounds], out)


def _sizes(counted: bytes) -> np.ndarray:
    found = np.frombuffer(counted, np.uint8)
    last = np.flatnonzero(found != 255)
    return np.diff(np.cumsum(found, dtype=np.int64)[last], prepend=0)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of runs of given starts and sizes, one run after the other, and where each begins among them."""
    stops = np.r_[0, np.cumsum(sizes)]
    return np.arange(stops[-1]) + np.repeat(starts - stops[:-1], sizes), stops


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


UNSTABLE = "the documents were not read in the same batches twice; store them first"


def _named(texts: pa.Array) -> int:
    """A number for a block that tells it apart by its texts."""
    bounds, data = _spans(texts)
    whole = xxhash.xxh64(np.diff(bounds).tobytes())
    whole.update(np.ascontiguousarray(data))
    return whole.intdigest() - (1 << 63)


def _texts(batch: pa.RecordBatch | pa.Table) -> pa.Array:
    column = batch.column("text")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    try:
        return column.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in column.to_pylist()], pa.large_string())


def _joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about that many bytes: the larger, the fewer units are sent twice."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(b.nbytes for b in held) + batch.nbytes > size:
            yield pa.concat_batches(held)
            held = []
        if batch.num_rows:
            held.append(batch)
    if held:
        yield pa.concat_batches(held)


def encoded(
    docs: DataFrame,
    pieces: Pieces | None = None,
    bucket_bytes: int = BUCKET_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Rows (doc_id, ids, text as binary), one per document.

    docs needs doc_id and text; other columns are ignored. A null or empty text has no
    ids. A blank character of the model in a text counts as a space. Repeated rows are
    encoded alike, rows without an id too; an empty table gives no rows. A block of texts
    (8 MB, or one longer text) and its units are in memory at once. docs has to give
    the same batches when it is read again, as files do; otherwise this raises.
    """
    spark = prepare(docs.sparkSession)
    pieces = pieces or Pieces.load()
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-int(size) // bucket_bytes))
    kind = "<u2" if len(pieces.names) <= 65_536 else "<u4"
    wide = int(kind[2])
    joins = pieces.joins()

    def units_of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _joined(batches, block_bytes):
            texts = _texts(batch)
            _, _, units = _cut(texts, joins)
            order, runs = _asked(units, buckets)
            none, end = (pa.scalar(s, pa.large_binary()) for s in (b"", bytes([END])))
            ended = pc.binary_join_element_wise(units.take(pa.array(order)), none, end)
            starts, data = _spans(ended)
            bounds = np.array([r[1] for r in runs] + [len(units)], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_named(texts)] * len(runs), pa.int64()),
                    pa.array([r[0] for r in runs], pa.int32()),
                    _strings(starts[bounds], data).cast(pa.binary()),
                ],
                names=["block", "bucket", "units"],
            )

    def packed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _joined(batches, block_bytes):
            name, data = _named(_texts(batch)), _packed(batch)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([data], pa.binary())], names=["block", "docs"])

    def distinct(key: tuple, rows: pa.Table) -> pa.Table:
        units = _sent(rows)[1].unique().cast(pa.string())
        units = units.filter(pc.less_equal(pc.utf8_length(units), LONGEST_FOLDED))
        home = pa.array(np.full(len(units), key[0].as_py(), np.int32))
        return pa.table({"home": home, "unit": pc.replace_substring(units, " ", BLANK)})

    def answer(key: tuple, rows: pa.Table, found: pa.Table) -> pa.Table:
        bounds, units = _sent(rows)
        known = pc.replace_substring(found.column("unit").combine_chunks(), BLANK, " ").cast(pa.large_binary())
        lists = found.column("ids").combine_chunks()
        sizes, ids = pc.list_value_length(lists).to_numpy(zero_copy_only=False), lists.flatten().to_numpy()
        at = pc.index_in(units, value_set=known)
        if at.null_count:
            other = units.filter(at.is_null()).unique()
            long = LongUnits(pieces)
            more = [long.ids(u.decode().replace(" ", BLANK)) for u in other.to_pylist()]
            sizes, ids = np.r_[sizes, [len(m) for m in more]], np.r_[ids, np.concatenate(more)]
            at = pc.index_in(units, value_set=pa.concat_arrays([known, other]))
        at, sizes = at.to_numpy(), sizes.astype(np.int64)
        places, stops = _runs((np.cumsum(sizes) - sizes)[at], sizes[at])
        return pa.table(
            {
                "block": rows.column("block"),
                "bucket": pa.array(np.full(rows.num_rows, key[0].as_py(), np.int32)),
                "sizes": _counted(sizes[at], bounds).cast(pa.binary()),
                "ids": _strings(stops[bounds] * wide, ids[places].astype(kind).view(np.uint8)).cast(pa.binary()),
            }
        )

    def assemble(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        columns = (replies.column(c).to_pylist() for c in ("bucket", "sizes", "ids"))
        reply = {bucket: (sizes, ids) for bucket, sizes, ids in zip(*columns)}
        if not rows.num_rows:
            raise RuntimeError(UNSTABLE)
        # Blocks go by their content, so repeated ones have one name and one reply.
        return pa.concat_tables([block_ids(data.as_buffer(), reply) for data in rows.column("docs")])

    def block_ids(data: pa.Buffer, reply: dict[int, tuple[bytes, bytes]]) -> pa.Table:
        batch = pa.ipc.open_stream(data).read_all()
        ends, codes, units = _cut(_texts(batch), joins)
        order, runs = _asked(units, buckets)
        if any(b not in reply for b, _, _ in runs):
            raise RuntimeError(UNSTABLE)
        sizes = np.zeros(len(units), np.int64)
        sizes[order] = _sizes(b"".join([reply[b][0] for b, _, _ in runs]))
        values = np.frombuffer(b"".join([reply[b][1] for b, _, _ in runs]), kind)
        first = np.zeros(len(units), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        # Each unit of the texts, in turn, as the run of its ids.
        places, stops = _runs(first[codes], sizes[codes])
        offsets = np.r_[0, stops[ends]].astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values[places].astype(np.int32)))
        return pa.table({"doc_id": batch.column("doc_id"), "ids": ids, "text": batch.column("text")})

    sent = texts.mapInArrow(units_of_blocks, "block long, bucket int, units binary")
    asked = sent.repartition(buckets, "bucket")
    # The name differs from asked's, so that the two can meet below. All columns pass, so
    # that both uses of what is dealt by bucket share one exchange. Units are dealt again by
    # what they were dealt by, as the edges need to know it.
    short = asked.groupBy("bucket").applyInArrow(distinct, "home int, unit string").repartition(buckets, "home")
    found = encoded_units(short, pieces, ["home", "unit"])
    replies = (
        asked.groupBy("bucket")
        .cogroup(found.groupBy("home"))
        .applyInArrow(answer, "block long, bucket int, sizes binary, ids binary")
    )
    blocks = texts.mapInArrow(packed_blocks, "block long, docs binary")
    return (
        blocks.groupBy("block")
        .cogroup(replies.groupBy("block"))
        .applyInArrow(assemble, "doc_id long, ids array<int>, text binary")
    )


def decoded(rows: DataFrame, pieces: Pieces | None = None, ids: str = "ids") -> DataFrame:
    """rows with a column decoded: the text of the ids; null for null ids, and no ids are no text."""
    spark = prepare(rows.sparkSession)
    pieces = pieces or Pieces.load()
    last = pieces.first_byte + 255
    names = [
        f"{i - pieces.first_byte:02X}" if pieces.first_byte <= i <= last
        else name.replace(BLANK, " ").encode().hex().upper() if ok else ""
        for i, (name, ok) in enumerate(zip(pieces.names, pieces.normal))
    ]
    table = spark.createDataFrame([(names,)], "names array<string>").scalar()
    hexed = rows.withColumn("_names", table)
    digits = F.array_join(F.transform(ids, lambda i: F.get(F.col("_names"), i)), "")
    # The blank put before the first word is no part of the text.
    text = F.unhex(F.regexp_replace(digits, "\\A20", "")).cast("string")
    return hexed.withColumn("decoded", text).drop("_names")
