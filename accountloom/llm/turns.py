"""Repair of conversation structure by a dynamic program with square-root checkpoints.

A repaired conversation is empty, or an optional system turn and then user and assistant
in turn. Rows are kept, given another role, or deleted, and empty turns are inserted, at
least cost; of equally cheap repairs the one whose edits spell the least string wins.

The program's backward state is four costs, one per place in that pattern. Conversations
are cut into blocks of as many rows as the square root of the longest one. A block's rows
act on the costs as a 4 x 4 matrix over (min, +), so one pass over a row per block leaves
the costs at every checkpoint. Each block is then computed again between its checkpoints,
all blocks at once, and walked forward from each of the four states; another pass over a
row per block tells which of the four walks is the conversation's. So a conversation of any
length is split over many tasks, and none holds more than a block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accountloom.llm.common import prepare, stored

SPACES = " \t\n\x0b\x0c\r"
LEAST_ROWS, MOST_ROWS = 64, 4096
BLOCK_BYTES = 1024 * 1024

# What the edits cost.
RENAME, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
# States: nothing yet, after system, after user, after assistant. The role that each
# needs next, as code and as text, and the state that follows it.
NEEDED, NEEDED_ROLE, AFTER = (1, 1, 2, 1), ("user", "user", "assistant", "user"), (2, 2, 3, 2)
SYSTEM, OTHER = 0, 3
BLANK, TRUNCATED, DUPLICATE, ROLE = 4, 8, 16, 3
_FAR = 1 << 60


def _with_inserts(base: list[int]) -> list[int]:
    user, assistant = min(base[2], INSERT + base[3]), min(base[3], INSERT + base[2])
    return [min(base[0], INSERT + user), min(base[1], INSERT + user), user, assistant]


END = _with_inserts([0, _FAR, _FAR, 0])


def _next(state: int, code: int) -> int | None:
    """The state after keeping a row, if it may be kept."""
    role = code & ROLE
    if role == NEEDED[state]:
        return AFTER[state]
    return 1 if state == 0 and role == SYSTEM else None


def _before(code: int, after: list[int]) -> list[int]:
    """The costs before a row, given those after it."""
    base = [DELETE + v for v in after]
    if not code & (BLANK | DUPLICATE):
        more = CUT_SHORT if code & TRUNCATED else 0
        for state in range(4):
            to = _next(state, code)
            kept = after[to] if to is not None else RENAME + after[AFTER[state]]
            base[state] = min(base[state], more + kept)
    return _with_inserts(base)


def transfer(codes: bytes) -> list[int]:
    """The block as a matrix: at 4 * i + j, the cost of going from state i before it to j after it."""
    columns = []
    for j in range(4):
        costs = [0 if i == j else _FAR for i in range(4)]
        # Inserts after the last row belong to the next block, or to the end.
        for code in reversed(codes):
            costs = [min(v, _FAR) for v in _before(code, costs)]
        columns.append(costs)
    return [columns[j][i] for i in range(4) for j in range(4)]


def backward(codes: bytes, end: list[int]) -> list[list[int]]:
    """The costs before each row, and those at the end."""
    costs = [end]
    for code in reversed(codes):
        costs.append(_before(code, costs[-1]))
    return costs[::-1]


def walk(codes: bytes, costs: list[list[int]], state: int, last: bool) -> tuple[str, int]:
    """The least cheapest edits from a state before the block, and the state after it."""
    edits = []
    for i, code in enumerate(codes):
        after = costs[i + 1]
        more = CUT_SHORT if code & TRUNCATED else 0
        while True:
            here = costs[i][state]
            if here == DELETE + after[state]:
                edits.append("D")
                break
            if here == INSERT + costs[i][AFTER[state]]:
                edits.append("I")
                state = AFTER[state]
                continue
            to = _next(state, code)
            if to is not None and here == more + after[to]:
                edits.append("K")
                state = to
            else:
                edits.append("R")
                state = AFTER[state]
            break
    while last and state in (1, 2):
        edits.append("I")
        state = AFTER[state]
    return "".join(edits), state


def _coded(turns: DataFrame) -> DataFrame:
    """Rows with their code (role and own faults) and a digest that equal turns share."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    first, rest = F.substring("role", 1, 1), F.btrim("text", F.lit(SPACES))
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(OTHER)
    fault = F.when(rest == "", BLANK).when(~F.right(rest, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(0)
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.octet_length("role"), F.lit(":"), "role", "text")
    return (
        turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
        .withColumn("code", (initial + fault).cast("int"))
        .withColumn("digest", F.unhex(F.sha2(named, 256)))
    )


_BLOCK = {
    "at": pa.int64(),
    "codes": pa.binary(),
    "digests": pa.list_(pa.binary()),
    "roles": pa.list_(pa.string()),
    "texts": pa.list_(pa.string()),
    "turns": pa.list_(pa.int64()),
}


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    of = lambda k: f"array<{names[k.value_type]}>" if pa.types.is_list(k) else names[k]
    return ", ".join(f"{n} {of(k)}" for n, k in kinds.items())


def _rows_of(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], names=list(kinds))


def _blocks(rows: int, size: int, id_type: pa.DataType):
    """Sorted rows put together to blocks, numbered in the order of the rows."""
    kinds = {"conv_id": id_type, **_BLOCK}
    names = ["code", "digest", "role", "text", "turn"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block, conv, held = None, None, 0

        def close() -> tuple:
            codes, digests, roles, texts, turns = block
            return conv, number, bytes(codes), digests, roles, texts, turns

        for batch in batches:
            done = []
            for row in zip(*(batch.column(c).to_pylist() for c in ["conv_id", *names])):
                full = block is not None and (len(block[0]) >= rows or held >= size)
                if block is None or row[0] != conv or full:
                    if block is not None:
                        done.append(close())
                        number += 1
                    block, conv, held = [[] for _ in names], row[0], 0
                if row[1] is not None:  # else the row only tells that there is this conversation
                    for column, value in zip(block, row[1:]):
                        column.append(value)
                    held += len(row[3]) + len(row[4])
            if done:
                yield _rows_of(done, kinds)
        if block is not None:
            yield _rows_of([close()], kinds)

    return run


_TRANSFER = {"at": pa.int64(), "codes": pa.binary(), "matrix": pa.list_(pa.int64())}


def _transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = []
        for conv, at, codes, places in zip(*(c.to_pylist() for c in batch.columns)):
            marked = bytearray(codes)
            for i in places or ():
                if not marked[i] & BLANK:
                    marked[i] = marked[i] & ROLE | DUPLICATE
            done.append((conv, at, bytes(marked), transfer(marked)))
        kinds = {"conv_id": batch.schema.field(0).type, **_TRANSFER}
        yield _rows_of(done, kinds)


_CHECKPOINT = {"at": pa.int64(), "costs": pa.list_(pa.int64()), "last": pa.int64()}


def _checkpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The costs at the end of each block, from rows in order of conversation and falling number."""
    conv, costs = object(), END
    for batch in batches:
        done = []
        for name, at, matrix in zip(*(c.to_pylist() for c in batch.columns)):
            last = name != conv
            if last:
                conv, costs = name, END
            done.append((at, costs, int(last)))
            costs = [min(matrix[4 * i + j] + costs[j] for j in range(4)) for i in range(4)]
        yield _rows_of(done, _CHECKPOINT)


_WALK = {
    "at": pa.int64(), "codes": pa.binary(), "cost": pa.int64(), "audits": pa.list_(pa.string()), "exits": pa.list_(pa.int64())
}


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = []
        for conv, at, codes, end, last in zip(*(c.to_pylist() for c in batch.columns)):
            costs = backward(codes, end)
            walks = [walk(codes, costs, state, bool(last)) for state in range(4)]
            done.append((conv, at, codes, costs[0][0], *zip(*walks)))
        yield _rows_of(done, {"conv_id": batch.schema.field(0).type, **_WALK})


_CHOSEN = {
    "at": pa.int64(), "state": pa.int64(), "audit": pa.string(), "cost": pa.int64(), "blank": pa.int64(), "duplicate": pa.int64(),
    "truncated": pa.int64(), "illegal": pa.int64(),
}
_LEGAL = ((SYSTEM, 1), (1, 2), (2, 1))


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's walk from the state in which the blocks before it end, and its counts.

    Rows come in order of conversation and number; cost is the whole one, at its first block.
    """
    conv, state, before = object(), 0, None
    for batch in batches:
        done = []
        for name, at, codes, cost, audits, exits in zip(*(c.to_pylist() for c in batch.columns)):
            first = name != conv
            if first:
                conv, state, before = name, 0, None
            roles = [c & ROLE for c in codes]
            pairs = zip(roles[:-1] if before is None else [before, *roles[:-1]], roles[1:] if before is None else roles)
            illegal = sum(p not in _LEGAL for p in pairs)
            counts = (sum(1 for c in codes if c & flag) for flag in (BLANK, DUPLICATE, TRUNCATED))
            done.append((name, at, state, audits[state], cost if first else 0, *counts, illegal))
            state, before = exits[state], roles[-1] if roles else before
        yield _rows_of(done, {"conv_id": batch.schema.field(0).type, **_CHOSEN})


_REPAIRED = {"block": pa.int64(), "place": pa.int64(), "role": pa.string(), "text": pa.string()}


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired turns of each block; block and place order them within a conversation."""
    for batch in batches:
        kinds = {"conv_id": batch.schema.field(0).type, **_REPAIRED}
        for conv, at, codes, roles, texts, state, audit in zip(*(c.to_pylist() for c in batch.columns)):
            done, i = [], 0
            for edit in audit:
                if edit == "K":
                    done.append((conv, at, len(done), roles[i], texts[i]))
                    state = _next(state, codes[i])
                elif edit in "RI":
                    done.append((conv, at, len(done), NEEDED_ROLE[state], texts[i] if edit == "R" else ""))
                    state = AFTER[state]
                i += edit != "I"
            if done:
                yield _rows_of(done, kinds)


class Repairs:
    """What repairing some conversations gives: audits and turns.

    turns needs conv_id, turn, role and text; other columns are ignored. conversations
    (conv_id) names further ones that are to be in the result though they have no row.

    A null role or text is one blank. Rows without a conv_id are one conversation. Within a
    conversation rows are in order of turn, nulls first; of rows with one turn those with
    the lesser role (as bytes) come first, then those with the lesser SHA-256 of their
    conversation, role and text. Equal rows are duplicates of the first. A conversation
    without rows has zeros and an empty audit, an empty table no conversations.
    """

    def __init__(self, turns: DataFrame, conversations: DataFrame | None = None, block_rows: int | None = None):
        spark = prepare(turns.sparkSession)
        coded = _coded(turns)
        if conversations is not None:
            coded = coded.unionByName(conversations.select("conv_id").distinct(), allowMissingColumns=True)
        if block_rows is None:
            longest = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
            block_rows = min(max(math.isqrt(longest), LEAST_ROWS), MOST_ROWS)
        # Equal rows may take any order; the last key lets many of them spread over tasks.
        salted = coded.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
        order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "digest", "salt")]
        ordered = salted.repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
        empty = spark.createDataFrame([], turns.select("conv_id").schema).toArrow()
        id_type = f"conv_id {dict(turns.dtypes)['conv_id']}"
        blocks = ordered.mapInArrow(
            _blocks(block_rows, BLOCK_BYTES, empty.schema.field(0).type), f"{id_type}, {_ddl(_BLOCK)}"
        )
        self._blocks = blocks = stored(blocks, "blocks")

        rows = blocks.select("at", F.posexplode("digests").alias("i", "digest"))
        place = F.struct("at", "i")
        first = rows.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        repeated = rows.join(stored(first.select("digest", "first"), "first-turns"), "digest").filter(place != F.col("first"))
        repeats = stored(repeated.groupBy("at").agg(F.collect_list("i").alias("places")), "repeats")

        marked = blocks.select("conv_id", "at", "codes").join(repeats, "at", "left").select("conv_id", "at", "codes", "places")
        transfers = stored(marked.mapInArrow(_transfers, f"{id_type}, {_ddl(_TRANSFER)}"), "transfers")
        backward_order = transfers.select("conv_id", "at", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("at"))
        checkpoints = stored(backward_order.mapInArrow(_checkpoints, _ddl(_CHECKPOINT)), "checkpoints")
        between = transfers.join(checkpoints, "at").select("conv_id", "at", "codes", "costs", "last")
        walks = between.mapInArrow(_walks, f"{id_type}, {_ddl(_WALK)}")
        forward_order = walks.repartition("conv_id").sortWithinPartitions("conv_id", "at")
        self._chosen = stored(forward_order.mapInArrow(_chosen, f"{id_type}, {_ddl(_CHOSEN)}"), "walks")
        self._id_type = id_type

    def audits(self) -> DataFrame:
        """Per conversation its gaps, faults, illegal neighbours, cost and edits."""
        turn = self._blocks.select("conv_id", F.explode("turns").alias("turn")).distinct()
        gaps = turn.groupBy("conv_id").agg(
            (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")
        )
        counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
        pieces = F.array_sort(F.collect_list(F.struct("at", "audit")))
        totals = self._chosen.groupBy("conv_id").agg(
            *[F.sum(c).alias(c) for c in counts], F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit")
        )
        same = F.col("t.conv_id").eqNullSafe(F.col("g.conv_id"))
        return totals.alias("t").join(gaps.alias("g"), same, "left").select(
            "t.conv_id", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), *counts, "audit"
        )

    def turns(self) -> DataFrame:
        """Rows (conv_id, block, place, role, text): the repaired conversations, in order of block and place."""
        planned = self._blocks.select("conv_id", "at", "codes", "roles", "texts").join(
            self._chosen.select("at", "state", "audit"), "at"
        )
        columns = ["conv_id", "at", "codes", "roles", "texts", "state", "audit"]
        return planned.select(*columns).mapInArrow(_edited, f"{self._id_type}, {_ddl(_REPAIRED)}")


_DIGEST = {"repaired_sha256": pa.string()}


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, kinds = None, None, None
    for batch in batches:
        kinds = {"conv_id": batch.schema.field(0).type, **_DIGEST}
        done = []
        for name, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if digest is None or name != conv:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = name, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield _rows_of(done, kinds)
    if digest is not None:
        yield _rows_of([(conv, digest.hexdigest())], kinds)


def digests(turns: DataFrame) -> DataFrame:
    """Per conversation the SHA-256 of its lines role:text, joined by line ends.

    A digest needs a conversation's turns one after the other; its task keeps a batch of them.
    """
    id_type = f"conv_id {dict(turns.dtypes)['conv_id']}"
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "block", "place").select("conv_id", "role", "text")
    return ordered.mapInArrow(_digested, f"{id_type}, {_ddl(_DIGEST)}")


def damaged(turns: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after a fixed choice of damage by conversation and turn.

    Of twenty remainders of a crc32, 0 drops the row, 1 empties its text, 2 removes ends
    of sentences, 3 repeats the row, 4 makes it the user's. Nulls are one blank.
    """
    key = F.concat(*[x for c in ("conv_id", "turn") for x in (F.coalesce(F.col(c).cast("string"), F.lit(" ")), F.lit(":"))][:-1])
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), copies)).alias("_copy"),
    ).drop("_copy")


def audited(repairs: Repairs) -> DataFrame:
    """The audits with a digest of the repaired conversation."""
    none = hashlib.sha256().hexdigest()
    same = F.col("a.conv_id").eqNullSafe(F.col("d.conv_id"))
    found = repairs.audits().alias("a").join(digests(repairs.turns()).alias("d"), same, "left")
    return found.select("a.*", F.coalesce("d.repaired_sha256", F.lit(none)).alias("repaired_sha256"))
