"""Repair of conversations at least cost, by a dynamic programme over runs of equal turns.

A legal conversation is empty, or an optional system turn followed by pairs of a user and an
assistant turn. A turn is a symbol: its role's initial, and whether it must go (blank, or a copy
of an earlier turn) or is truncated. For each symbol a 4 x 4 matrix holds the least cost of
reading one such turn between two states of the legal grammar; matrices multiply by (min, +). Equal
consecutive symbols are a run, and a run of n turns is crossed by the powers of its matrix that
make up n in binary, each squared once and cached. Costs to go are computed from the end to the
front; then the edits are unrolled from the front, splitting a power into its two halves down to single
turns, and the least letter among the cheapest edits is taken, so that the audit is the least string.
Halves with equal costs to go are unrolled once.

Spark places the turns by conversation and turn (a range sort, so that a large conversation takes
as many tasks as its size asks for) and writes them once, in blocks. A conversation that lies in one
block, as nearly all do, is repaired where it is read. One that spans blocks is repaired by parts: a part's
matrix is the product of its runs, costs to go pass from part to part through these matrices, every
part is unrolled from each of the four states, and the states are chained. Only such numbers meet
in one task for a conversation, a row for 8 MB of turns; what a part must know of the parts before it are
the hashes of its own turns that occur there.

Nulls, ties and odd tables: null roles and texts are one space; null turns come first; turns of a
conversation with the same number come in the order of role and text (of their first 64 characters, then of
a hash); rows that repeat each other are duplicates; turns without a conversation id are a conversation. Long texts
are read whole. An empty table gives no rows. Extra columns of any name are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.ranking import join_null_safe
from cadence.llm.blocks import write_bucketed
from cadence.llm.common import cut, query, read

BLOCK_BYTES = 8 << 20     # a block ends with a conversation after so much text, or inside one after twice as much
PART_BYTES = 128 << 20    # text of a range of the placement
KNOWN = 100_000           # conversations of few turns whose repair a worker remembers
SHORT = 64                # turns of such a conversation

# States of the grammar: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
FOLLOWS = (USER, USER, ASSISTANT, USER)          # the state after an inserted or rewritten turn
KEEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}, "o": {}}
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5   # costs; a truncated turn that stays adds the last one
NEVER = 1 << 60
#: Symbols by code: initial (s, u, a, other), the same truncated, and turns that must go.
SYMBOLS = "suaoSUAOx"
GONE = SYMBOLS.index("x")
LEGAL = [0 * 4 + 1, 1 * 4 + 2, 2 * 4 + 1]        # su, ua, au as 4 x initial + next initial
SPACED = " \t\n\x0b\x0c\r"

Vector = tuple[int, int, int, int]


@lru_cache(None)
def options(symbol: str, state: int) -> dict[str, tuple[int, int]]:
    """{edit: (cost, next state)} of reading one turn in a state."""
    out = {"D": (DELETE, state)}
    if symbol != "x":
        extra = TRUNCATED if symbol.isupper() else 0
        if state in KEEPS[symbol.lower()]:
            out["K"] = (extra, KEEPS[symbol.lower()][state])
        out["R"] = (REROLE + extra, FOLLOWS[state])
    return out


def times(a: tuple, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v)) for row in a)


def product(a: tuple, b: tuple) -> tuple:
    return tuple(zip(*(times(a, column) for column in zip(*b))))


def _inserts() -> tuple:
    """Least cost of insertions alone between two states."""
    cost = [[NEVER] * 4 for _ in range(4)]
    for i in range(4):
        state, spent = i, 0
        while cost[i][state] == NEVER:
            cost[i][state] = spent
            state, spent = FOLLOWS[state], spent + INSERT
    return tuple(map(tuple, cost))


INSERTS = _inserts()
IDENTITY = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))
END: Vector = times(INSERTS, tuple(0 if s in ENDS else NEVER for s in range(4)))


@lru_cache(None)
def power(symbol: str, k: int) -> tuple:
    """Least costs of reading 2**k turns of a symbol, with insertions before each of them."""
    if k:
        return product(power(symbol, k - 1), power(symbol, k - 1))
    turn = [[NEVER] * 4 for _ in range(4)]
    for i in range(4):
        for cost, j in options(symbol, i).values():
            turn[i][j] = min(turn[i][j], cost)
    return product(INSERTS, tuple(map(tuple, turn)))


def runs(symbols: str) -> list[tuple[str, int]]:
    """(symbol, k) for the powers of two that make up each run, larger ones first."""
    out = []
    for symbol, same in groupby(symbols):
        n = sum(1 for _ in same)
        out += [(symbol, k) for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]
    return out


def matrix(symbols: str) -> tuple:
    total = IDENTITY
    for symbol, k in runs(symbols):
        total = product(total, power(symbol, k))
    return total


@lru_cache(1 << 16)
def unroll_power(symbol: str, k: int, state: int, after: Vector) -> tuple[str, int]:
    """(edits, next state) of 2**k turns, where ``after`` is the cost to go behind them, less its least."""
    if k:
        left, middle = unroll_power(symbol, k - 1, state, _level(times(power(symbol, k - 1), after)))
        right, last = unroll_power(symbol, k - 1, middle, after)
        return left + right, last
    before, edits = times(power(symbol, 0), after), ""
    while True:
        here = options(symbol, state)
        if here["D"][0] + after[state] == before[state]:
            return edits + "D", state
        if INSERT + before[FOLLOWS[state]] == before[state]:
            edits, state = edits + "I", FOLLOWS[state]
            continue
        edit = next(e for e in ("K", "R") if e in here and here[e][0] + after[here[e][1]] == before[state])
        return edits + edit, here[edit][1]


def _level(v: Vector) -> Vector:
    least = min(v)
    return tuple(min(x - least, NEVER) for x in v)


def unroll(symbols: str, state: int, after: Vector = END, last: bool = True) -> tuple[str, int, int]:
    """(edits, next state, cost to go at the front) of the cheapest repair of ``symbols`` from ``state``
    on, the least string among equal ones; ``after`` is the cost to go behind them, and ``last`` says
    whether the conversation ends there."""
    pieces, to_go = runs(symbols), [after]
    for symbol, k in reversed(pieces):
        to_go.append(times(power(symbol, k), to_go[-1]))
    to_go.reverse()
    cost, edits = to_go[0][state], []
    for (symbol, k), behind in zip(pieces, to_go[1:]):
        e, state = unroll_power(symbol, k, state, _level(behind))
        edits.append(e)
    while last and END[state]:
        edits.append("I")
        state = FOLLOWS[state]
    return "".join(edits), state, cost


_known: dict[str, tuple[str, int]] = {}


def repair_symbols(symbols: str) -> tuple[str, int]:
    """(audit, cost) of a whole conversation; short ones are remembered."""
    found = _known.get(symbols)
    if found is None:
        if len(_known) >= KNOWN:
            _known.clear()
        audit, _, cost = unroll(symbols, START)
        found = (audit, cost)
        if len(symbols) <= SHORT:
            _known[symbols] = found
    return found


def edited(audit: str, symbols: str, state: int, first: int, total: int) -> tuple[list[int], list[int]]:
    """Rows of the texts and roles after ``audit``, where row ``total`` of the texts is an empty one, and
    ``total`` and ``total + 1`` of the roles are user and assistant."""
    text, role, row = [], [], 0
    for e in audit:
        if e == "D":
            row += 1
            continue
        text.append(total if e == "I" else first + row)
        if e == "K":
            state = KEEPS[symbols[row].lower()][state]
            role.append(first + row)
        else:
            state = FOLLOWS[state]
            role.append(total if state == USER else total + 1)
        row += e != "I"
    return text, role


def damage(turns: DataFrame) -> DataFrame:
    """The faults of the contract, told by a checksum of conversation and turn: one row in twenty is
    dropped, one emptied, one loses its full stops, one is repeated, one becomes the user's."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, role, text = F.crc32(key) % 20, F.coalesce("role", space), F.coalesce("text", space)
    return (turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"))
        .where("kind <> 0").withColumn("again", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("kind", "again"))


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPAIRED = ("conv_id long, segment long, " + ", ".join(f"{n} long" for n in NUMBERS)
            + ", audit string, turns array<struct<role:string,text:string>>")
PARTS = "conv_id long, segment long, " + ", ".join(f"{n} long" for n in NUMBERS) + ", after array<long>, last boolean, symbols string"
SEGMENTS = ("conv_id long, segment long, blank long, duplicate long, truncated long, illegal long, first_initial int, "
            "last_initial int, low long, high long, distinct_turns long, symbols string, matrix array<long>")


def place(turns: DataFrame) -> DataFrame:
    """``turns`` in order of conversation and turn, written once in blocks: (block, at, conv_id, turn,
    role, text, initial, fault), where initial is 0 to 3 for s, u, a and others, and fault 1 stands
    for truncated and 2 for blank."""
    spark = turns.sparkSession
    body = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    total = body.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))
    ending = F.substring(F.rtrim("text", F.lit(SPACED)), -1, 1)
    initial = F.substring("role", 1, 1)
    order = ["conv_id", "turn", "__role", "__text", "__hash"]
    placed = (body.withColumn("initial", F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3))
              .withColumn("fault", F.when(ending == "", 2).when(ending.isin(".", "!", "?"), 0).otherwise(1))
              .withColumn("__role", F.substring("role", 1, 64)).withColumn("__text", F.substring("text", 1, 64))
              .withColumn("__hash", F.xxhash64("role", "text")).withColumn("__tie", F.monotonically_increasing_id())
              .repartitionByRange(parts, *order, "__tie").sortWithinPartitions(*order, "__tie").drop(*order[2:], "__tie"))

    def number(batches):
        from pyspark import TaskContext
        block, held, at, last = TaskContext.get().partitionId() << 32, 0, 0, None
        for b in batches:
            size = pc.binary_length(b.column("text")).to_pylist()
            of = np.empty(b.num_rows, np.int64)
            for i, (conv, n) in enumerate(zip(b.column("conv_id").to_pylist(), size)):
                if held >= BLOCK_BYTES and (conv != last or held >= 2 * BLOCK_BYTES):
                    block, held = block + 1, 0
                of[i], last, held = block, conv, held + n
            yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(np.arange(at, at + b.num_rows)), *b.columns],
                                             names=["block", "at", *b.schema.names])
            at += b.num_rows

    schema = "block long, at long, conv_id long, turn long, role string, text string, initial int, fault int"
    return write_bucketed(placed.mapInArrow(number, schema), parts)


class Block:
    """The turns of a block in order, its conversations (or their parts) and the symbols of the turns."""

    def __init__(self, table: pa.Table, earlier: dict | None = None):
        """``earlier`` gives the hashes of turns that occur in earlier blocks, by conversation."""
        self.table = table = table.sort_by("at").combine_chunks()
        n = table.num_rows
        conv = pc.fill_null(table.column("conv_id"), 0).to_numpy()
        absent = table.column("conv_id").is_null().to_numpy()
        edge = np.flatnonzero((conv[1:] != conv[:-1]) | (absent[1:] != absent[:-1])) + 1
        self.edges = [0, *edge.tolist(), n]
        self.conversations = table.column("conv_id").take(pa.array(self.edges[:-1])).to_pylist()
        of = np.repeat(np.arange(len(self.conversations)), np.diff(self.edges))
        said = [pc.dictionary_encode(table.column(c).combine_chunks()) for c in ("role", "text")]
        key = [np.asarray(x.indices).astype(np.int64) for x in said]
        _, same = np.unique(key[0] * len(said[1].dictionary) + key[1], return_inverse=True)
        _, first = np.unique(of * n + same, return_index=True)
        again = np.ones(n, bool)
        again[first] = False
        self.earlier = earlier or {}
        for k, conv_id in enumerate(self.conversations):
            if seen := self.earlier.get(conv_id):
                rows = range(self.edges[k], self.edges[k + 1])
                again[[i for i, h in zip(rows, self.hashes(k)) if h in seen]] = True
        self.initial, fault = table.column("initial").to_numpy(), table.column("fault").to_numpy()
        self.faults = {"blank": fault == 2, "duplicate": again & (fault < 2), "truncated": ~again & (fault == 1)}
        code = np.where(self.faults["blank"] | again, GONE, self.initial + 4 * (fault == 1))
        self.symbols = np.frombuffer(SYMBOLS.encode(), np.uint8)[code].tobytes().decode()
        self.legal = np.isin(4 * self.initial[:-1] + self.initial[1:], LEGAL)

    def hashes(self, k: int) -> list[bytes]:
        rows = self.table.slice(self.edges[k], self.edges[k + 1] - self.edges[k])
        return [hashlib.sha256(b"%d:" % len(r) + r + t).digest() for r, t in zip(
            rows.column("role").cast(pa.binary()).to_pylist(), rows.column("text").cast(pa.binary()).to_pylist())]

    def spans(self) -> list[tuple[int, int, int]]:
        return list(zip(range(len(self.conversations)), self.edges, self.edges[1:]))

    def per_conversation(self, flags: np.ndarray) -> np.ndarray:
        """Number of set flags of each conversation."""
        total = np.concatenate([[0], np.cumsum(flags)])
        return np.diff(total[self.edges])

    def counts(self) -> dict[str, np.ndarray]:
        """Faults and illegal pairs of each conversation, and its numbered turns."""
        out = {k: self.per_conversation(v) for k, v in self.faults.items()}
        start = np.zeros(self.table.num_rows, bool)
        start[self.edges[:-1]] = True
        out["illegal"] = self.per_conversation(np.concatenate([[False], ~self.legal]) & ~start)
        known = self.table.column("turn").is_valid().to_numpy()
        turn = pc.fill_null(self.table.column("turn"), 0).to_numpy()
        new = known.copy()  # nulls come first
        new[1:] &= start[1:] | ~known[:-1] | (turn[1:] != turn[:-1])
        out["distinct_turns"] = self.per_conversation(new)
        last = np.asarray(self.edges[1:]) - 1
        lead = np.asarray(self.edges[:-1]) + self.per_conversation(~known)
        out["some"], out["high"] = known[last], turn[last]
        out["low"] = turn[np.minimum(lead, last)]
        return out


def _turns(block: Block, text: list, role: list, length: list[int]) -> pa.Array:
    """Lists of repaired turns from rows of the block's texts and roles (see `edited`)."""
    add = lambda c, more: pa.concat_arrays([block.table.column(c).combine_chunks(), pa.array(more, pa.string())])
    none = np.zeros(0, np.int64)
    turn = pa.StructArray.from_arrays([
        add("role", ["user", "assistant"]).take(pa.array(np.concatenate([none, *role]).astype(np.int64))),
        add("text", [""]).take(pa.array(np.concatenate([none, *text]).astype(np.int64)))], names=["role", "text"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), turn)


def _marked(right: pa.Table) -> dict:
    """{conversation: hashes of turns that it has in earlier blocks} for those that span blocks."""
    out: dict = {}
    for conv_id, h in zip(right.column("conv_id").to_pylist(), right.column("hash").to_pylist()):
        out.setdefault(conv_id, set())
        if h is not None:
            out[conv_id].add(h)
    return out


def repair_whole(turns: pa.Table, right: pa.Table) -> pa.Table:
    """Repaired conversations that lie in this block."""
    spanning = _marked(right)
    block = Block(turns)
    counts, n = block.counts(), turns.num_rows
    keep, audits, costs, text, role, length = [], [], [], [], [], []
    for k, start, end in block.spans():
        if block.conversations[k] in spanning:
            continue
        symbols = block.symbols[start:end]
        audit, cost = repair_symbols(symbols)
        if audit.count("K") == len(audit):
            rows = [np.arange(start, end)] * 2
        else:
            rows = edited(audit, symbols, START, start, n)
        keep.append(k)
        audits.append(audit)
        costs.append(cost)
        text.append(rows[0])
        role.append(rows[1])
        length.append(len(rows[0]))
    at = np.asarray(keep, np.int64)
    gaps = np.where(counts["some"], counts["high"] - counts["low"] + 1 - counts["distinct_turns"], 0)
    numbers = {"gaps": gaps, **counts}
    return pa.Table.from_arrays(
        [pa.array([block.conversations[k] for k in keep], pa.int64()), pa.array(np.zeros(len(keep), np.int64)),
         *[pa.array(numbers[c][at].astype(np.int64)) for c in NUMBERS[:-1]], pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
         _turns(block, text, role, length)], names=["conv_id", "segment", *NUMBERS, "audit", "turns"])


def read_segments(turns: pa.Table, right: pa.Table) -> pa.Table:
    """What the parts in this block of conversations that span blocks have to tell the other parts."""
    spanning = _marked(right)
    block = Block(turns, spanning)
    counts, out = block.counts(), []
    number = turns.column("block")[0].as_py() if turns.num_rows else 0
    for k, start, end in block.spans():
        if block.conversations[k] not in spanning:
            continue
        symbols, some = block.symbols[start:end], bool(counts["some"][k])
        low, high = (int(counts["low"][k]), int(counts["high"][k])) if some else (None, None)
        out.append((block.conversations[k], number, *[int(counts[c][k]) for c in ("blank", "duplicate", "truncated", "illegal")],
                    int(block.initial[start]), int(block.initial[end - 1]), low, high, int(counts["distinct_turns"][k]), symbols,
                    [x for row in matrix(symbols) for x in row]))
    return _rows(out, SEGMENTS)


def turn_hashes(turns: pa.Table, right: pa.Table) -> pa.Table:
    """The different turns that a conversation spanning blocks has in this one."""
    spanning, block = _marked(right), Block(turns)
    number = turns.column("block")[0].as_py() if turns.num_rows else 0
    return _rows([(number, c, h) for k, c in enumerate(block.conversations) if c in spanning for h in set(block.hashes(k))],
                 "block long, conv_id long, hash binary")


def join_parts(rows: pa.Table) -> pa.Table:
    """Costs to go behind every part of one conversation, and its numbers, which stand on the first part."""
    parts = rows.sort_by("segment").to_pylist()
    after, cost_to_go = [], END
    for p in reversed(parts):
        after.append(list(cost_to_go))
        cost_to_go = times(tuple(tuple(p["matrix"][4 * i:4 * i + 4]) for i in range(4)), cost_to_go)
    numbers = {n: sum(p[n] for p in parts) for n in ("blank", "duplicate", "truncated", "illegal")}
    numbers["illegal"] += sum(4 * p["last_initial"] + q["first_initial"] not in LEGAL for p, q in zip(parts, parts[1:]))
    known = [p for p in parts if p["low"] is not None]
    distinct = sum(p["distinct_turns"] for p in known) - sum(p["high"] == q["low"] for p, q in zip(known, known[1:]))
    numbers["gaps"] = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
    numbers["cost"] = cost_to_go[START]
    return _rows([(p["conv_id"], p["segment"], *[numbers[n] * (k == 0) for n in NUMBERS], a, k == len(parts) - 1, p["symbols"])
                  for k, (p, a) in enumerate(zip(parts, reversed(after)))], PARTS)


def chain(rows: pa.Table) -> pa.Table:
    """The state in which every part of one conversation begins."""
    state, out = START, []
    for p in rows.sort_by("segment").to_pylist():
        out.append((*[p[n] for n in ("conv_id", "segment", *NUMBERS, "after", "last", "symbols")], state))
        state = p["ends"][state]
    return _rows(out, PARTS + ", state int")


def repair_parts(turns: pa.Table, right: pa.Table) -> pa.Table:
    """Repaired parts, in this block, of conversations that span blocks."""
    block, n = Block(turns), turns.num_rows
    parts = {p["conv_id"]: p for p in right.to_pylist()}
    rows, text, role = [], [], []
    for k, start, _ in block.spans():
        if p := parts.get(block.conversations[k]):
            audit, _, _ = unroll(p["symbols"], p["state"], tuple(p["after"]), p["last"])
            t, r = edited(audit, p["symbols"], p["state"], start, n)
            text.append(t)
            role.append(r)
            rows.append((p["conv_id"], p["segment"], *[p[c] for c in NUMBERS], audit))
    plain = _rows(rows, REPAIRED.rsplit(", turns", 1)[0])
    return plain.append_column("turns", _turns(block, text, role, [len(t) for t in text]))


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
             "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows)) or [[]] * len(fields)
    return pa.Table.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


def repair_by_size(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Repaired conversations that lie in one block, and the parts of those that don't (see `repair`)."""
    blocks = place(turns)
    ends = (blocks.groupBy("block").agg(F.min_by("conv_id", "at").alias("first"), F.max_by("conv_id", "at").alias("last"))
            .select("block", F.explode(F.array_distinct(F.array("first", "last"))).alias("conv_id")))
    several = ends.groupBy("conv_id").agg(F.count("block").alias("blocks")).where("blocks > 1").drop("blocks")
    marks = cut(join_null_safe(ends, several, ["conv_id"], "inner").withColumn("hash", F.lit(None).cast("binary")))
    whole = blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(repair_whole, REPAIRED)

    touched = blocks.join(marks.select("block").distinct(), "block", "left_semi")
    said = cut(touched.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(turn_hashes, "block long, conv_id long, hash binary"))
    first = said.groupBy("conv_id", "hash").agg(F.min("block").alias("first"))
    earlier = join_null_safe(said, first, ["conv_id", "hash"], "inner").where("block > first").select("block", "conv_id", "hash")
    known = marks.unionByName(earlier)
    segments = touched.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(read_segments, SEGMENTS)
    parts = segments.groupBy("conv_id").applyInArrow(join_parts, PARTS)

    def exits(batches):
        for b in batches:
            ends = [[unroll(p["symbols"], state, tuple(p["after"]), p["last"])[1] for state in range(4)] for p in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ends, pa.list_(pa.int32()))], names=[*b.schema.names, "ends"])

    states = parts.mapInArrow(exits, PARTS + ", ends array<int>").groupBy("conv_id").applyInArrow(chain, PARTS + ", state int")
    answers = cut(states).withColumn("block", F.col("segment"))
    spread = touched.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(repair_parts, REPAIRED)
    return whole, spread


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, segment, gaps, blank, duplicate, truncated, illegal, cost, audit, turns): the repaired turns
    of every conversation, in order. A conversation is one row, or, if it spans blocks, several in
    the order of ``segment``: their audits and turns follow each other and their numbers add up."""
    whole, spread = repair_by_size(turns)
    return whole.unionByName(spread)


def conversation_report(turns: DataFrame) -> DataFrame:
    """One row per conversation: the numbers and audit of `repair`, and the SHA-256 of the repaired lines.
    The lines of a conversation that spans blocks are hashed one part after the other as they arrive,
    since a SHA-256 can only be taken in order; no more than a part is held."""
    whole, spread = repair_by_size(turns)
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    columns = ["conv_id", *NUMBERS, "audit"]
    lines = lambda df, *more: df.select(*columns, *more, F.concat_ws("\n", line).alias("lines"), F.size("turns").alias("n"))

    def digest(batches):
        now = None

        def close():
            return [(now[0], *now[1], "".join(now[2]), now[3].hexdigest())]

        for b in batches:
            rows = []
            for r in b.to_pylist():
                if now is None or r["conv_id"] != now[0]:
                    rows += close() if now else []
                    now = [r["conv_id"], [0] * len(NUMBERS), [], hashlib.sha256(), False]
                now[1] = [x + r[c] for x, c in zip(now[1], NUMBERS)]
                now[2].append(r["audit"])
                now[3].update((b"\n" if now[4] and r["n"] else b"") + r["lines"].encode())
                now[4] = now[4] or r["n"] > 0
            if rows:
                yield from _rows(rows, schema).to_batches()
        if now:
            yield from _rows(close(), schema).to_batches()

    schema = "conv_id long, " + ", ".join(f"{n} long" for n in NUMBERS) + ", audit string, repaired_sha256 string"
    in_order = lines(spread, "segment").repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    return lines(whole).select(*columns, F.sha2("lines", 256).alias("repaired_sha256")).unionByName(in_order.mapInArrow(digest, schema))


@query("op12_conversation_repair")
def op12_conversation_repair(spark, sf_dir):
    conversations = read(spark, sf_dir, "conversations")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    report = join_null_safe(every, conversation_report(damage(conversations)), ["conv_id"])
    empty = F.sha2(F.lit(""), 256)
    return report.select("conv_id", *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in NUMBERS],
                         F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
