"""Packing documents into token windows by non-negative least squares over lengths.

Documents longer than a window are cut into full windows and a rest. How often each
length occurs (at most as many numbers as a window has tokens, whatever the input) is
what the driver plans with: it enumerates the combinations of few lengths that fill a
window, solves for the repeat counts that use up the histogram, rounds them, and packs
what is left greedily, cutting a piece where no whole one fits. The plan gives each
range of ranks within a length its sequences and offsets, and every piece finds its
own place by its rank; the ranks are counted in parallel.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accountloom.llm.common import prepare, shuffle_partitions, stored
from accountloom.llm.tokens import RANKS, VOCABULARY, Encoder

WINDOW = 2048
END_ID = 1
DEPTH = 3
GRAIN = 8
LEAST_CUT = 16
TEXTS_AT_ONCE = 2_000_000
PIECE = "piece_id long, doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids binary"


def pieces_of(
    docs: DataFrame,
    window: int = WINDOW,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
    ranks: str = RANKS,
    all_ids: bool = False,
) -> DataFrame:
    """The documents' full windows and rests, in the columns of PIECE; ids of rests, or all.

    ids are little-endian unsigned 32-bit integers. A null text is an empty one, whose
    only token is the end. piece_id is unique but not the same in another run.
    """
    prepare(docs.sparkSession)

    def cut(batch: pa.RecordBatch, encoder: Encoder, first: int) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(7)]
        ending = end_id.to_bytes(4, "little")
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for doc_id, text in zip(ids, texts):
            found = encoder.encode(text or "") + ending
            total = len(found) // 4
            for start in range(0, total, window):
                part = found[4 * start : 4 * (start + window)]
                length = len(part) // 4
                values = (
                    first + len(out[0]), doc_id, start, length, total,
                    zlib.crc32(part), part if all_ids or length < window else None,
                )
                for column, value in zip(out, values):
                    column.append(value)
        types = [pa.int64()] * 6 + [pa.binary()]
        names = [x.split()[0] for x in PIECE.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, first = Encoder(vocabulary, ranks), TaskContext.get().partitionId() << 33
        for batch in batches:
            step = max(1, batch.num_rows * TEXTS_AT_ONCE // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, step):
                done = cut(batch.slice(at, step), encoder, first)
                first += done.num_rows
                yield done

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECE)


def combinations(units: int, depth: int) -> np.ndarray:
    """All non-decreasing choices of up to three parts that sum to units; 0 marks no part."""
    found = [(units, 0, 0)]
    if depth >= 2:
        found += [(a, units - a, 0) for a in range(1, units // 2 + 1)]
    if depth >= 3:
        found += [
            (a, b, units - a - b) for a in range(1, units // 3 + 1) for b in range(a, (units - a) // 2 + 1)
        ]
    return np.array(found)


def repeat_counts(combos: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """Non-negative least squares by the active-set method of Lawson and Hanson.

    histogram[u] is the number of pieces of u units; index 0 is not used. The result is
    how often each combination is repeated so that the pieces used match the histogram.
    """
    rows, scale = len(histogram), max(1.0, float(histogram.max(initial=0)))
    target = histogram / scale
    target[0] = 0.0

    def dense(columns: list[int]) -> np.ndarray:
        out = np.zeros((rows, len(columns)))
        for i in range(combos.shape[1]):
            np.add.at(out, (combos[columns, i], np.arange(len(columns))), 1.0)
        out[0] = 0.0
        return out

    x, active = np.zeros(len(combos)), []
    residual = target.copy()
    for _ in range(3 * rows):
        gradient = residual[combos].sum(axis=1)
        gradient[active] = -1.0
        best = int(gradient.argmax())
        if gradient[best] <= 1e-7:
            break
        active.append(best)
        while True:
            matrix = dense(active)
            normal = matrix.T @ matrix + 1e-10 * np.eye(len(active))
            solved = np.linalg.solve(normal, matrix.T @ target)
            if solved.min() > 0 or len(active) == 1:
                break
            now = x[active]
            falling = solved <= 0
            ratio = np.where(falling, now / np.maximum(now - solved, 1e-300), np.inf)
            moved = now + min(1.0, ratio.min()) * (solved - now)
            moved[ratio <= ratio.min()] = 0.0
            x[active] = np.maximum(moved, 0.0)
            active = [a for a in active if x[a] > 0]
            if not active:
                break
        x[:] = 0.0
        if not active:
            break
        x[active] = np.maximum(solved, 0.0)
        residual = target - matrix @ x[active]
    return x * scale


class Stock:
    """Unplaced pieces by length, as runs of ranks: (length found, first rank, how many, cut from)."""

    def __init__(self, histogram: dict[int, int]):
        self.runs: dict[int, deque] = defaultdict(deque)
        self.count: dict[int, int] = defaultdict(int)
        for length, n in histogram.items():
            self.put(length, (length, 0, n, 0))

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        self.runs[length].append(run)
        self.count[length] += run[2]

    def take(self, length: int, n: int) -> list[tuple[int, int, int, int]]:
        taken = []
        self.count[length] -= n
        while n:
            found, rank, size, cut = self.runs[length].popleft()
            if size > n:
                self.runs[length].appendleft((found, rank + n, size - n, cut))
                size = n
            taken.append((found, rank, size, cut))
            n -= size
        return taken


class Plan:
    """Rows (length, rank, ranks, cut_from, cut_length, sequence, repeats, slot, offset)."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, ...]] = []
        self.sequences = 0

    def place(self, runs: list[tuple], length: int, repeats: int, offset: int) -> None:
        """Pieces of one length in the next repeats sequences, one after another from the offset."""
        slot = 0
        for found, rank, size, cut in runs:
            self.rows.append((found, rank, size, cut, length, self.sequences, repeats, slot, offset))
            slot += size


def _least_squares(stock: Stock, plan: Plan, window: int, depth: int, grain: int) -> None:
    units = window // grain
    by_unit: dict[int, list[int]] = defaultdict(list)
    for length in sorted(stock.count, reverse=True):
        by_unit[-(-length // grain)].append(length)
    histogram = np.zeros(units + 1)
    for unit, lengths in by_unit.items():
        histogram[unit] = sum(stock.count[x] for x in lengths)
    combos = combinations(units, depth)
    wanted = np.rint(repeat_counts(combos, histogram)).astype(np.int64)
    for i in np.argsort(-wanted, kind="stable")[: int((wanted > 0).sum())]:
        parts = [int(u) for u in combos[i] if u]
        left = [sum(stock.count[x] for x in by_unit[u]) // parts.count(u) for u in set(parts)]
        repeats = min([int(wanted[i]), *left])
        while repeats:
            # The longest left of each unit, as often as all of them last.
            need: dict[int, int] = defaultdict(int)
            chosen = []
            for u in parts:
                length = next(x for x in by_unit[u] if stock.count[x] > need.get(x, 0))
                need[length] += 1
                chosen.append(length)
            n = min([repeats, *(stock.count[x] // m for x, m in need.items())])
            offset = 0
            for length in chosen:
                plan.place(stock.take(length, n), length, n, offset)
                offset += length
            plan.sequences += n
            repeats -= n


def _greedy(stock: Stock, plan: Plan, window: int, least_cut: int) -> None:
    """Longest first, then what fits best; where nothing fits, the head of the longest left."""
    while lengths := sorted((x for x, n in stock.count.items() if n), reverse=True):
        chosen, space = [], window
        need: dict[int, int] = defaultdict(int)
        for length in lengths:
            many = min(space // length, stock.count[length])
            if not chosen:
                many = 1 if 2 * length > window else many
            if many:
                chosen.append((length, many))
                need[length] += many
                space -= many * length
        repeats = min(stock.count[x] // m for x, m in need.items())
        longest = next((x for x in lengths if stock.count[x] > need.get(x, 0) and x > space), 0)
        cut = longest if space >= least_cut else 0
        if cut:
            need[cut] += 1
            repeats = min(stock.count[x] // m for x, m in need.items())
        offset = 0
        for length, many in chosen:
            plan.place(stock.take(length, many * repeats), length, repeats, offset)
            offset += many * length
        if cut:
            heads = stock.take(cut, repeats)
            plan.place(heads, space, repeats, offset)
            for found, rank, size, start in heads:
                stock.put(cut - space, (found, rank, size, start + space))
        plan.sequences += repeats


def planned(
    histogram: dict[int, int],
    window: int = WINDOW,
    depth: int = DEPTH,
    grain: int = GRAIN,
    least_cut: int = LEAST_CUT,
) -> Plan:
    """Where the pieces of each length go; lengths are 1 to window."""
    plan, rest = Plan(), dict(histogram)
    if full := rest.pop(window, 0):
        plan.place([(window, 0, full, 0)], window, full, 0)
        plan.sequences += full
    stock = Stock({x: n for x, n in rest.items() if n})
    _least_squares(stock, plan, window, depth, grain)
    _greedy(stock, plan, window, least_cut)
    return plan


PLACE = (
    "length long, first_rank long, ranks long, cut_from long, cut_length long, "
    "first_sequence long, repeats long, slot long, first_offset long"
)


def packed(
    docs: DataFrame,
    window: int = WINDOW,
    end_id: int = END_ID,
    vocabulary: str = VOCABULARY,
    ranks: str = RANKS,
    depth: int = DEPTH,
    grain: int = GRAIN,
    least_cut: int = LEAST_CUT,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    docs needs doc_id and text; other columns are ignored. Each document ends with
    end_id. Sequences hold at most window tokens, without gaps; only their ends are
    padded. A null text is empty and makes a piece of one token. A row that repeats is
    packed again; null ids are kept. An empty table gives no rows. with_ids adds the
    pieces' token ids as little-endian unsigned 32-bit integers.
    """
    spark = prepare(docs.sparkSession)
    pieces = stored(pieces_of(docs, window, end_id, vocabulary, ranks, with_ids), "pieces")
    # A length that a third of all pieces have is counted in as many blocks as all others.
    blocks = max(1024, 8 * shuffle_partitions(spark))
    keyed = pieces.drop("ids").withColumn("block", F.pmod(F.xxhash64("piece_id"), F.lit(blocks)))
    counts = stored(keyed.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n")), "block-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = planned(histogram, window, depth, grain, least_cut)
    places = F.broadcast(spark.createDataFrame(plan.rows, PLACE))

    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    firsts = stored(
        counts.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")),
        "first-ranks",
    )
    within = Window.partitionBy("length", "block").orderBy("piece_id")
    ranked = keyed.withColumn("_row", F.row_number().over(within) - 1).join(firsts, ["length", "block"])
    rank = (F.col("first") + F.col("_row")).alias("rank")
    place = F.col("slot") + F.col("rank") - F.col("first_rank")
    found = (
        ranked.select("piece_id", "doc_id", "start", "length", "doc_tokens", "ids_crc32", rank)
        .join(places, "length")
        .filter("rank >= first_rank AND rank < first_rank + ranks")
        .select(
            "piece_id", "doc_id", (F.col("start") + F.col("cut_from")).alias("start"),
            F.col("cut_length").alias("length"), "ids_crc32", "doc_tokens",
            (F.col("first_sequence") + F.pmod(place, F.col("repeats"))).alias("sequence_id"),
            (F.col("first_offset") + F.floor(place / F.col("repeats")) * F.col("cut_length")).cast("long").alias("offset"),
            "cut_from", (F.col("cut_length") != F.col("length")).alias("is_cut"),
        )
    )
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    part = F.substring("ids", (4 * F.col("cut_from") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    if with_ids:
        joined = found.join(pieces.select("piece_id", "ids"), "piece_id")
        return joined.withColumn("ids", part).withColumn("ids_crc32", F.crc32("ids")).select(*out, "ids")
    cut_lengths = sorted({row[0] for row in plan.rows if row[4] != row[0]})
    if not cut_lengths:
        return found.select(out)
    found = stored(found, "placed")
    ids = pieces.filter(F.col("length").isin(cut_lengths)).select("piece_id", "ids")
    mended = found.filter("is_cut").join(ids, "piece_id").withColumn("ids_crc32", F.crc32(part))
    return found.filter("NOT is_cut").select(out).unionByName(mended.select(out))
