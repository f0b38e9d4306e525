"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

Only repeats of a fixed length count, so suffixes need ordering no deeper than that.
The sort goes from the most significant digit down, a suffix that is alone in its group
leaves at once, and groups that are equal through the whole depth are the repeated
windows. To spare the exchange of all suffixes, the first digit is an anchor: each
window of `depth` bytes is known by the gram inside it whose hash is least, which equal
windows share at the same place. The passes are

1. anchors by the hash of their gram, in packed arrays: grams of one document only leave;
2. the others by the bytes around them, which hold all windows of the anchor: where
   one string is all there is, its windows need no further look;
3. what differs, window by window, eight bytes a digit, to the full depth.

Passes 2 and 3 compare bytes. Blocks send each distinct string once, so a passage that
a third of all documents share costs one entry per block. A gram with very many different
strings, a stock phrase in ever other surroundings, would bring all of them to one task.
Its windows are dealt by 128 bits of hash of their own bytes instead, which stand for them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accountloom.llm.blocks import (
    BLOCK_BYTES,
    LEAST_BUCKETS,
    NO_ID,
    Block,
    block_count,
    buckets_of,
    in_blocks,
    slices,
)
from accountloom.llm.common import prepare

DEPTH = 50
GRAM = 24
# A bit of a mask for each window of an anchor.
MOST_WINDOWS = 32
# Strings of one gram that may meet in a task; counts are known within a factor of four.
HOT_STRINGS = 50_000
AT_ONCE = 1 << 18
WINDOWS_AT_ONCE = 1 << 17

_TABLE = np.random.default_rng(50).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OTHER = np.random.default_rng(52).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.random.default_rng(51).integers(1, 2**63, 1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def gram_hashes(data: np.ndarray, size: int, table: np.ndarray = _TABLE) -> np.ndarray:
    """A hash of each run of size bytes, by doubling."""
    power, width, out, have = table[data], 1, None, 0
    n = len(data) - size + 1
    while True:
        if size & width:
            part = power[have : have + n]
            out = part.copy() if out is None else out * _STEP[width] + part
            have += width
        if have == size:
            return _mixed(out)
        power = power[:-width] * _STEP[width + 1] + power[width:]
        width *= 2


def _least_over(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of width values."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


class Anchors:
    """The anchors of a block: place, first and last window, document and gram hash of each."""

    def __init__(self, block: Block, depth: int = DEPTH, gram: int = GRAM):
        self.text = b"".join(block.texts)
        data = np.frombuffer(self.text, np.uint8)
        # Windows that would reach into the next document are none.
        valid = np.zeros(len(data) + 1, np.int32)
        length = block.ends - block.starts
        long = length >= depth
        np.add.at(valid, block.starts[long], 1)
        np.add.at(valid, block.ends[long] - depth + 1, -1)
        valid = np.cumsum(valid, out=valid)[: len(data)] > 0
        parts = [self._slice(data, valid, at, depth, gram) for at in range(0, len(data), AT_ONCE)]
        parts = parts or [(np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)]
        self.at, self.first, self.last, self.gram = (np.concatenate(x) for x in zip(*parts))
        self.doc = np.searchsorted(block.ends, self.first, "right")

    @staticmethod
    def _slice(data: np.ndarray, valid: np.ndarray, at: int, depth: int, gram: int) -> tuple:
        here = np.flatnonzero(valid[at : at + AT_ONCE])
        if not len(here):
            return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
        hashes = gram_hashes(data[at : at + AT_ONCE + depth - 1], gram)
        order = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
        least = _least_over(order, depth - gram + 1)[here] & np.uint64(0xFFFFFFFF)
        place = least.astype(np.int64)
        new = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        ends = np.r_[new[1:], len(place)] - 1
        # Minima are small numbers; mixed once more, one to one, they spread evenly over the buckets.
        return place[new] + at, here[new] + at, here[ends] + at, _mixed(hashes[place[new]])


def _five_bytes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _from_five(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8")[:, 0]


class Ranked:
    """The anchors of a block in order of their grams."""

    def __init__(self, anchors: Anchors, ids: np.ndarray):
        self.order = np.argsort(anchors.gram)
        gram = anchors.gram[self.order]
        self.new = np.r_[True, gram[1:] != gram[:-1]] if len(gram) else np.empty(0, bool)
        self.starts = np.flatnonzero(self.new)
        self.grams = gram[self.starts]
        self._doc = ids[anchors.doc[self.order]]

    def several(self) -> np.ndarray:
        """Whether more than one document id has the gram."""
        if not len(self.starts):
            return np.empty(0, bool)
        return np.minimum.reduceat(self._doc, self.starts) < np.maximum.reduceat(self._doc, self.starts)

    def levels(self) -> np.ndarray:
        """How often each gram occurs, as a power of four, 7 at most."""
        counts = np.diff(np.r_[self.starts, len(self.order)])
        return np.minimum(np.floor(np.log2(np.maximum(counts, 1)) / 2), 7).astype(np.uint64)


def radix_groups(first: list[np.ndarray], lines: np.ndarray) -> np.ndarray:
    """Group number of each row by all digits, most significant first; -1 for rows alone.

    The digits are first the given numbers, then eight bytes of lines at a time. A row
    that is alone in its group leaves before the next digit is looked at.
    """
    n, width = lines.shape
    group, rows = np.zeros(n, np.int64), np.arange(n)
    for i in range(len(first) + -(-width // 8)):
        if i < len(first):
            keys = first[i][rows]
        else:
            at = 8 * (i - len(first))
            digit = np.zeros((len(rows), 8), np.uint8)
            digit[:, : min(8, width - at)] = lines[rows, at : at + 8]
            keys = digit.view(">u8")[:, 0].astype(np.uint64)
        order = np.lexsort((keys, group[rows]))
        rows, keys = rows[order], keys[order]
        above = group[rows]
        new = np.r_[True, (above[1:] != above[:-1]) | (keys[1:] != keys[:-1])] if len(rows) else np.empty(0, bool)
        number = np.cumsum(new) - 1
        shared = np.bincount(number)[number] > 1 if len(rows) else new
        group[rows] = np.where(shared, number, -1)
        rows = rows[shared]
        if not len(rows):
            break
    return group


def _runs(keys: np.ndarray, sizes: np.ndarray, most: int) -> list[slice]:
    """Slices of sorted keys, each of whole keys and of about the given total size."""
    if not len(keys):
        return []
    before = np.cumsum(sizes) - sizes
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    part = before[new] // most
    starts = new[np.r_[True, part[1:] != part[:-1]]]
    return [slice(a, b) for a, b in zip(starts, np.r_[starts[1:], len(keys)])]


def window_masks(
    grams: np.ndarray, docs: np.ndarray, places: np.ndarray, counts: np.ndarray, text: np.ndarray, depth: int
) -> np.ndarray:
    """For each entry a bit per window: whether a smaller document has the same window.

    An entry is a string of counts + depth - 1 bytes, one after another in text, with
    its least document and its anchor's place.
    """
    if not len(grams):
        return np.empty(0, np.uint32)
    sizes = counts + depth - 1
    starts = np.cumsum(sizes) - sizes
    width = int(sizes.max())
    column = np.arange(width)
    padded = np.r_[text, np.zeros(width, np.uint8)]
    lines = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    lines[column >= sizes[:, None]] = 0
    shape = places.astype(np.uint64) * np.uint64(256) + counts.astype(np.uint64)
    group = radix_groups([grams, shape], lines)
    alone = group < 0
    group[alone] = np.arange(int(alone.sum())) + (group.max(initial=-1) + 1)
    _, first, string = np.unique(group, return_index=True, return_inverse=True)
    least = np.full(len(first), NO_ID)
    np.minimum.at(least, string, docs)

    # Windows of different strings of one gram; where a gram has one string, it decides.
    # Equal windows have equal grams, so grams can be taken some at a time.
    gram_of = grams[first]
    _, gram_number, how_many = np.unique(gram_of, return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(how_many[gram_number] > 1)
    mixed = mixed[np.argsort(gram_number[mixed], kind="stable")]
    most = int(counts.max())
    known = np.where(np.arange(most) < counts[first][:, None], least[:, None], NO_ID)
    windows_of = np.lib.stride_tricks.sliding_window_view(padded, depth)
    for some in _runs(gram_number[mixed], counts[first][mixed], WINDOWS_AT_ONCE):
        own = mixed[some]
        many = counts[first][own]
        rows = np.repeat(own, many)
        offset = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
        same = radix_groups([gram_of[rows]], windows_of[starts[first[rows]] + offset])
        shared = same >= 0
        lowest = np.full(int(same.max(initial=-1)) + 1, NO_ID)
        np.minimum.at(lowest, same[shared], least[rows[shared]])
        known[rows[shared], offset[shared]] = lowest[same[shared]]
    hit = known[string] < docs[:, None]
    bits = np.uint32(1) << np.arange(most, dtype=np.uint32)
    return (hit * bits).sum(axis=1, dtype=np.uint32)


class HotWindows:
    """The windows of a block's anchors of hot grams: place and document of each, and the distinct ones."""

    def __init__(self, anchors: Anchors, kept: np.ndarray, block: Block, depth: int, buckets: int):
        many = anchors.last[kept] - anchors.first[kept] + 1
        rows = np.repeat(kept, many)
        self.at = anchors.first[rows] + np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
        self.doc = block.ids[anchors.doc[rows]]
        if not len(rows):
            self.hashes, self.least, self.number, self.runs = np.empty((2, 0), np.uint64), self.doc, self.at, []
            return
        data = np.frombuffer(anchors.text, np.uint8)
        both = np.stack([gram_hashes(data, depth, table)[self.at] for table in (_TABLE, _OTHER)])
        order = np.lexsort(both[::-1])
        new = np.r_[True, (both[:, order[1:]] != both[:, order[:-1]]).any(axis=0)]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.hashes = both[:, order[new]]
        self.least = np.minimum.reduceat(self.doc[order], np.flatnonzero(new))
        self.runs = slices(buckets_of(self.hashes[0], buckets).astype(np.int64))

    def repeated(self, answers: dict[int, bytes]) -> np.ndarray:
        """Where the windows start that a smaller document has too."""
        smaller = np.zeros(len(self.least), bool)
        for bucket, a, b in self.runs:
            smaller[a:b] = np.unpackbits(np.frombuffer(answers[bucket], np.uint8))[: b - a]
        return self.at[(self.doc > self.least[self.number]) | smaller[self.number]]


def smaller_elsewhere(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each entry whether an entry of the same two hashes has a smaller document."""
    order = np.lexsort(hashes[::-1])
    new = np.r_[True, (hashes[:, order[1:]] != hashes[:, order[:-1]]).any(axis=0)]
    least = np.minimum.reduceat(docs[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    out = np.empty(len(order), bool)
    out[order] = least < docs[order]
    return out


class Candidates:
    """Anchors of a block whose gram other documents have too, and their distinct strings."""

    def __init__(
        self,
        block: Block,
        replies: dict[int, bytes],
        hot_replies: dict[int, bytes],
        depth: int,
        gram: int,
        buckets: int,
    ):
        anchors = Anchors(block, depth, gram)
        ranked = Ranked(anchors, block.ids)
        flags = np.zeros(len(ranked.grams), bool)
        for bucket, a, b in slices(buckets_of(ranked.grams, buckets).astype(np.int64)):
            flags[a:b] = np.unpackbits(np.frombuffer(replies[bucket], np.uint8))[: b - a]
        hot = np.zeros(len(ranked.grams), bool)
        for bucket, a, b in slices(buckets_of(ranked.grams, buckets).astype(np.int64)):
            if bucket in hot_replies:
                hot[a:b] = np.unpackbits(np.frombuffer(hot_replies[bucket], np.uint8))[: b - a]
        number_of = np.cumsum(ranked.new) - 1
        self.hot = HotWindows(anchors, ranked.order[hot[number_of]], block, depth, buckets)
        kept = ranked.order[(flags & ~hot)[number_of]]
        # Equal grams keep the order of their places, which any task finds again.
        kept = kept[np.lexsort((kept, anchors.gram[kept]))]
        self.first, self.last = anchors.first[kept], anchors.last[kept]
        self.doc = block.ids[anchors.doc[kept]]
        place = anchors.at[kept] - self.first
        grams = anchors.gram[kept]
        # Equal strings have equal grams, so the strings of one gram are all that is held.
        number: dict[tuple, int] = {}
        firsts: list[int] = []
        text, string = anchors.text, np.empty(len(kept), np.int64)
        new = np.r_[True, grams[1:] != grams[:-1]][: len(grams)]
        spans = zip(self.first.tolist(), (self.last + depth).tolist(), place.tolist(), new.tolist())
        for i, (a, b, at, is_new) in enumerate(spans):
            if is_new:
                number.clear()
            found = number.setdefault((text[a:b], at), len(firsts))
            if found == len(firsts):
                firsts.append(i)
            string[i] = found
        one = np.array(firsts, np.int64)
        self._text, self._from, self._to = text, self.first[one], self.last[one] + depth
        self.string = string
        self.places = place[one].astype(np.uint8)
        self.counts = (self.last[one] - self.first[one] + 1).astype(np.uint8)
        self.least = np.full(len(one), NO_ID)
        np.minimum.at(self.least, string, self.doc)
        self.grams = grams[one]
        # Strings are numbered in the order of their grams, so buckets are runs.
        self.runs = slices(buckets_of(self.grams, buckets).astype(np.int64))

    def text_of(self, a: int, b: int) -> bytes:
        """The strings from number a to b, one after another."""
        spans = zip(self._from[a:b].tolist(), self._to[a:b].tolist())
        return b"".join([self._text[x:y] for x, y in spans])


def _joined_replies(replies: pa.Table, kind: int) -> dict[int, bytes]:
    found = zip(
        replies.column("kind").to_pylist(),
        replies.column("bucket").to_pylist(),
        replies.column("reply").to_pylist(),
    )
    return {bucket: reply for k, bucket, reply in found if k == kind}


def _packed(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True)


def _unpacked(rows: pa.Table, name: str) -> np.ndarray:
    """A column of compressed bytes, all rows one after another."""
    sizes = rows.column(f"{name}_size").to_pylist()
    parts = zip(rows.column(name).to_pylist(), sizes)
    return np.frombuffer(b"".join([pa.decompress(x, n, codec="zstd", asbytes=True) for x, n in parts]), np.uint8)


_REPLY = "block int, bucket int, kind int, reply binary"


def _arrow(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.Table:
    return pa.table({name: pa.array(columns[name], kind) for name, kind in types.items()})


def _nullable(structs: pa.StructArray) -> pa.StructArray:
    return structs.cast(pa.struct([pa.field(f.name, f.type) for f in structs.type]))


_REPLY_TYPES = {"block": pa.int32(), "bucket": pa.int32(), "kind": pa.int32(), "reply": pa.binary()}


def without_repeats(
    docs: DataFrame,
    depth: int = DEPTH,
    gram: int | None = None,
    block_bytes: int = BLOCK_BYTES,
    as_text: bool = False,
    hot_strings: int = HOT_STRINGS,
) -> DataFrame:
    """Every document with what is left of its text once repeated byte strings are removed.

    Rows (doc_id, kept, n_bytes, n_removed, n_spans, rest: the other columns). kept is
    binary, or with as_text a string without the parts of characters that a removed
    string left behind.
    Each byte covered by a string of depth bytes that also starts in a document with a
    smaller doc_id goes; strings are judged on the input. A null text is empty. Rows with
    one id do not affect each other; a null id counts as larger than all others, and
    rows without an id do not affect each other. An empty table gives no rows. gram is as
    long as the depth asks for, 24 at least; an anchor has at most 32 windows. A string's
    anchors are found by 64-bit hashes of their grams, of which 44 bits are compared across
    blocks; a chance match costs work and cannot remove anything.
    """
    gram = max(GRAM, depth - MOST_WINDOWS + 6) if gram is None else gram
    if not 0 < gram <= depth < gram + MOST_WINDOWS or gram >= len(_STEP):
        raise ValueError(f"a gram of {gram} bytes for a depth of {depth}: 0 < gram <= depth < gram + {MOST_WINDOWS}")
    prepare(docs.sparkSession)
    blocks = block_count(docs, block_bytes)
    buckets = max(LEAST_BUCKETS, blocks)
    dealt = in_blocks(docs, blocks)

    def ask_grams(key: tuple, rows: pa.Table) -> pa.Table:
        block = Block(rows)
        ranked = Ranked(Anchors(block, depth, gram), block.ids)
        grams = ranked.grams
        # 36 bits of the gram beside those of its bucket, 3 of its count, and whether it is shared.
        packed = (grams & np.uint64((1 << 36) - 1)) << np.uint64(4)
        packed |= (ranked.levels() << np.uint64(1)) | ranked.several().astype(np.uint64)
        runs = slices(buckets_of(grams, buckets).astype(np.int64))
        return _arrow(
            {
                "bucket": [r[0] for r in runs],
                "block": [key[0].as_py()] * len(runs),
                "grams": [_five_bytes(packed[a:b]) for _, a, b in runs],
            },
            {"bucket": pa.int32(), "block": pa.int32(), "grams": pa.binary()},
        )

    def answer_grams(key: tuple, rows: pa.Table) -> pa.Table:
        sent = [_from_five(x) for x in rows.column("grams").to_pylist()]
        packed = np.concatenate(sent)
        order = np.argsort(packed >> np.uint64(4), kind="stable")
        gram_sorted = packed[order] >> np.uint64(4)
        same = np.r_[False, gram_sorted[1:] == gram_sorted[:-1]]
        flags = np.empty(len(packed), bool)
        flags[order] = same | np.r_[same[1:], False]
        flags |= (packed & np.uint64(1)).astype(bool)
        often = np.left_shift(1, 2 * ((packed[order] >> np.uint64(1)) & np.uint64(7)).astype(np.int64))
        total = np.add.reduceat(often, np.flatnonzero(~same))
        hot = np.empty(len(packed), bool)
        hot[order] = (total >= hot_strings)[np.cumsum(~same) - 1]
        hot &= flags
        ends = np.cumsum([len(x) for x in sent])[:-1]
        blocks_of = rows.column("block").to_pylist()
        some = [(b, h) for b, h in zip(blocks_of, np.split(hot, ends)) if h.any()]
        replies = [(b, 1, x) for b, x in zip(blocks_of, np.split(flags, ends))] + [(b, 3, h) for b, h in some]
        return _arrow(
            {
                "block": [r[0] for r in replies],
                "bucket": [key[0].as_py()] * len(replies),
                "kind": [r[1] for r in replies],
                "reply": [np.packbits(r[2]).tobytes() for r in replies],
            },
            _REPLY_TYPES,
        )

    def candidates(rows: pa.Table, replies: pa.Table) -> tuple[Block, Candidates]:
        block = Block(rows)
        known = (_joined_replies(replies, kind) for kind in (1, 3))
        return block, Candidates(block, *known, depth, gram, buckets)

    def ask_windows(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        _, found = candidates(rows, replies)
        runs = found.runs
        texts = [found.text_of(a, b) for _, a, b in runs]
        # Half a gram's hash is enough to tell apart the grams of a bucket; where two
        # agree by chance, their strings' bytes do not.
        grams = found.grams.astype(np.uint32)
        # Windows of hot grams: their hashes stand in the columns of grams and texts.
        hot = found.hot
        return _arrow(
            {
                "bucket": [r[0] for r in runs + hot.runs],
                "block": [key[0].as_py()] * len(runs + hot.runs),
                "grams": [grams[a:b].tobytes() for _, a, b in runs] + [hot.hashes[0, a:b].tobytes() for _, a, b in hot.runs],
                "docs": [found.least[a:b].tobytes() for _, a, b in runs] + [hot.least[a:b].tobytes() for _, a, b in hot.runs],
                "places": [found.places[a:b].tobytes() for _, a, b in runs] + [None] * len(hot.runs),
                "counts": [found.counts[a:b].tobytes() for _, a, b in runs] + [None] * len(hot.runs),
                "texts": [_packed(x) for x in texts] + [hot.hashes[1, a:b].tobytes() for _, a, b in hot.runs],
                "texts_size": [len(x) for x in texts] + [None] * len(hot.runs),
            },
            {"bucket": pa.int32(), "block": pa.int32()}
            | {c: pa.binary() for c in ("grams", "docs", "places", "counts", "texts")}
            | {"texts_size": pa.int32()},
        )

    def answer_windows(key: tuple, rows: pa.Table) -> pa.Table:
        def all_of(some: pa.Table, name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(some.column(name).to_pylist()), kind)

        is_hot = pc.is_null(rows.column("texts_size"))
        hot, rows = rows.filter(is_hot), rows.filter(pc.invert(is_hot))
        replies: list[tuple[int, int, bytes]] = []
        if rows.num_rows:
            masks = window_masks(
                all_of(rows, "grams", np.uint32).astype(np.uint64),
                all_of(rows, "docs", np.int64),
                all_of(rows, "places", np.uint8),
                all_of(rows, "counts", np.uint8).astype(np.int64),
                _unpacked(rows, "texts"),
                depth,
            )
            sizes = [len(x) for x in rows.column("places").to_pylist()]
            parts = np.split(masks, np.cumsum(sizes)[:-1])
            replies += [(b, 2, x.tobytes()) for b, x in zip(rows.column("block").to_pylist(), parts)]
        if hot.num_rows:
            hashes = np.stack([all_of(hot, name, np.uint64) for name in ("grams", "texts")])
            smaller = smaller_elsewhere(hashes, all_of(hot, "docs", np.int64))
            sizes = [len(x) // 8 for x in hot.column("docs").to_pylist()]
            parts = np.split(smaller, np.cumsum(sizes)[:-1])
            replies += [(b, 4, np.packbits(x).tobytes()) for b, x in zip(hot.column("block").to_pylist(), parts)]
        return _arrow(
            {
                "block": [r[0] for r in replies],
                "bucket": [key[0].as_py()] * len(replies),
                "kind": [r[1] for r in replies],
                "reply": [r[2] for r in replies],
            },
            _REPLY_TYPES,
        )

    out_schema = f"doc_id long, kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long, rest "
    out_schema += dealt.schema["rest"].dataType.simpleString()

    def remove(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        block, found = candidates(rows, replies)
        masks = np.zeros(len(found.grams), np.uint32)
        answers = _joined_replies(replies, 2)
        for bucket, a, b in found.runs:
            masks[a:b] = np.frombuffer(answers[bucket], np.uint32)
        size = int(block.ends[-1]) if len(block.ends) else 0
        change = np.zeros(size + 1, np.int32)
        later = found.doc > found.least[found.string]
        np.add.at(change, found.first[later], 1)
        np.add.at(change, found.last[later] + depth, -1)
        own = np.flatnonzero(~later)
        for j in range(depth - gram + 1):
            hit = own[(masks[found.string[own]] >> np.uint32(j)) & np.uint32(1) == 1]
            np.add.at(change, found.first[hit] + j, 1)
            np.add.at(change, found.first[hit] + j + depth, -1)
        hit = found.hot.repeated(_joined_replies(replies, 4))
        np.add.at(change, hit, 1)
        np.add.at(change, hit + depth, -1)
        gone = np.cumsum(change, out=change)[:-1] > 0
        data = np.frombuffer(b"".join(block.texts), np.uint8)
        kept, removed, spans = [], [], []
        for a, b in zip(block.starts.tolist(), block.ends.tolist()):
            out = gone[a:b]
            removed.append(int(out.sum()))
            spans.append(int((out[1:] & ~out[:-1]).sum() + out[:1].sum()))
            kept.append(data[a:b][~out].tobytes() if removed[-1] else data[a:b].tobytes())
        return pa.table(
            {
                "doc_id": block.doc_ids,
                "kept": pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
                if as_text
                else pa.array(kept, pa.binary()),
                "n_bytes": pa.array((block.ends - block.starts).tolist(), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "rest": _nullable(rows.column("rest").combine_chunks()).take(pa.array(block.order, pa.int64())),
            }
        )

    asked = dealt.groupBy("block").applyInArrow(ask_grams, "bucket int, block int, grams binary")
    shared = asked.groupBy("bucket").applyInArrow(answer_grams, _REPLY)
    strings = (
        dealt.groupBy("block")
        .cogroup(shared.groupBy("block"))
        .applyInArrow(
            ask_windows,
            "bucket int, block int, grams binary, docs binary, places binary, counts binary, texts binary, texts_size int",
        )
    )
    windows = strings.groupBy("bucket").applyInArrow(answer_windows, _REPLY)
    replies = shared.unionByName(windows)
    return (
        dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(remove, out_schema)
    )


def cleaned(docs: DataFrame, **options) -> DataFrame:
    """The documents with their own columns, repeated strings removed from text."""
    found = without_repeats(docs, as_text=True, **options)
    columns = {"doc_id": F.col("doc_id"), "text": F.col("kept")}
    kinds = dict(docs.dtypes)
    return found.select(
        *[columns.get(c, F.col(f"rest.`{c}`")).cast(kinds[c]).alias(c) for c in docs.columns]
    )
