"""Cheapest repair of conversation structure, by Four-Russians block tables.

The rows of a conversation become symbols: the role's initial (s, u, a or another), whether the
text is cut off, and whether the row must go (blank, or a repeat). A repair keeps, reroles,
deletes and inserts rows until the roles read `(s?(ua)+)?`. The cost of finishing from a row is
a vector over the four states of that pattern. Normalised by its least value such a vector is
one of a few, so for every vector and every block of `BLOCK` symbols the vector in front of the
block is precomputed. Blocks are looked up from the end of a conversation to its start; then
each block is expanded backward from the vector behind it, and the rows are traced forward,
always by the first letter (Delete, Insert, Keep, Rerole) that a cheapest repair can go on
with: the audit is the least in ASCII order of all cheapest ones.

At scale: rows get their place in the order of all conversations by one range sort of slim rows
(no texts). Places are cut into parts of `PART_ROWS`, packed as one byte per row. A part looks
up and traces its conversations by itself; of one that runs on in other parts, it first gives
the vector in front for each vector behind, and the state behind for each state in front. These
small maps are chained per conversation, so a conversation with most of all rows is as many
tasks as it has parts. Repeats are found by grouping hashes (SHA-256), where frequent ones are
met by broadcast. Only `summary` streams each conversation's texts through one task in order,
as a SHA-256 is a chain and the audit one value; it holds no more than the audit.

Defined results: null roles and texts count as one space, a null conversation id is one
conversation; rows follow by `turn` (nulls first), then role, then the text's SHA-256; repeated
rows are repeats, also in the same turn; an empty or unknown role is never kept; empty and blank
texts must go, very long ones are only hashed; an empty table gives no rows; columns of the
input sit inside `row`, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bounded_batches, field, hot_join, ranked, written

PART_ROWS = 1 << 16
BLOCK = 4

# ---- the pattern, the symbols and the costs -----------------------------------------------

#: States of (s?(ua)+)?: nothing yet, after s, after u, after a.
STATES = 4
ACCEPTED = (True, False, False, True)
#: The one role that may be inserted, or a row be changed to, in a state; the state behind it.
NEXT_ROLE = ("user", "user", "assistant", "user")
NEXT_STATE = (2, 2, 3, 2)
INITIALS = "sua"
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
#: Symbols: initial (s, u, a, other) + 4 if cut off; must go; none (in front of a first block).
GOES, NONE, SYMBOLS = 8, 9, 10
ACTIONS = "DKR"
BLANK_CHARACTERS = " \t\n\v\f\r"


def kept_state(initial: int, state: int) -> int | None:
    """The state behind a kept row, None if the pattern does not allow it."""
    if INITIALS[initial : initial + 1] == "s":
        return 1 if state == 0 else None
    return NEXT_STATE[state] if NEXT_ROLE[state][0] == INITIALS[initial : initial + 1] else None


def choices(symbol: int, state: int, behind: tuple[int, ...], front: tuple[int, ...] | None) -> dict:
    """(cost, state behind) per letter; an insertion stays in front of the row."""
    out = {"D": (DELETE + behind[state], state)}
    if symbol != GOES:
        initial, more = symbol % 4, CUT_OFF * (symbol >= 4)
        kept = kept_state(initial, state)
        if kept is not None:
            out["K"] = (more + behind[kept], kept)
        out["R"] = (REROLE + more + behind[NEXT_STATE[state]], NEXT_STATE[state])
    if front is not None:
        out["I"] = (INSERT + front[NEXT_STATE[state]], NEXT_STATE[state])
    return out


def inserted(costs: list[int | float]) -> tuple[int, ...]:
    """Costs per state when rows may be inserted as well."""
    for _ in range(STATES):
        costs = [min(c, INSERT + costs[NEXT_STATE[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


class Tables:
    """All vectors that occur, and what symbols and blocks of symbols do to them."""

    def __init__(self):
        self.vectors = [inserted([0 if a else float("inf") for a in ACCEPTED])]
        steps: list[list[int]] = []
        traces: list[list[list[tuple[int, int, int]]]] = []
        for behind in self.vectors:  # grows while it is walked through
            steps.append([])
            traces.append([])
            for symbol in range(SYMBOLS):
                if symbol == NONE:
                    front, trace = behind, [(0, -1, s) for s in range(STATES)]
                else:
                    front = inserted(
                        [min(c for c, _ in choices(symbol, s, behind, None).values()) for s in range(STATES)]
                    )
                    trace = [self.first(symbol, s, behind, front) for s in range(STATES)]
                low = min(front)
                normal = tuple(c - low for c in front)
                if normal not in self.vectors:
                    self.vectors.append(normal)
                steps[-1].append(self.vectors.index(normal))
                traces[-1].append(trace)
        #: [vector behind, symbol]: vector in front.
        self.step = np.array(steps, np.int16)
        #: [vector behind, symbol, state in front]: insertions, action, state behind.
        self.trace = np.array(traces, np.int8)
        #: [vector behind, block]: vector in front, composed from the last symbol to the first.
        self.block = np.repeat(np.arange(len(self.vectors), dtype=np.int16)[:, None], 1, 1)
        for _ in range(BLOCK):
            # A symbol in front of shorter blocks is their highest digit.
            self.block = self.step[self.block].transpose(0, 2, 1).reshape(len(self.vectors), -1)
        #: Insertions that end a conversation in a state.
        self.ends = np.array([self.vectors[0][s] // INSERT for s in range(STATES)], np.int8)

    @staticmethod
    def first(symbol: int, state: int, behind: tuple, front: tuple) -> tuple[int, int, int]:
        """The least letters of a cheapest repair, up to the one that consumes the row."""
        inserts = 0
        while True:
            best = choices(symbol, state, behind, front)
            letter = min(k for k, (c, _) in best.items() if c == front[state])
            state = best[letter][1]
            if letter != "I":
                return inserts, ACTIONS.index(letter), state
            inserts += 1


@lru_cache(1)
def tables() -> Tables:
    return Tables()


class Pieces:
    """The conversations in a part, as blocks that end with their last rows."""

    #: True for copies of one piece, which share its blocks.
    shared = False

    def __init__(self, symbols: np.ndarray, starts: np.ndarray):
        lengths = np.diff(np.append(starts, len(symbols)))
        self.blocks = -(-lengths // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(self.blocks)[:-1]]).astype(np.int64)
        self.at = np.arange(len(symbols)) + np.repeat(
            (self.first + self.blocks) * BLOCK - (starts + lengths), lengths
        )
        filled = np.full(int(self.blocks.sum()) * BLOCK, NONE, np.int64)
        filled[self.at] = symbols
        self.symbols = filled.reshape(-1, BLOCK)
        self.codes = self.symbols @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))

    def only(self, i: int, times: int) -> Pieces:
        """Piece i, several times."""
        out = object.__new__(Pieces)
        rows = slice(self.first[i], self.first[i] + self.blocks[i])
        out.symbols, out.codes = self.symbols[rows], self.codes[rows]
        out.blocks, out.first = np.repeat(self.blocks[i], times), np.zeros(times, np.int64)
        out.shared = True
        return out

    def _active(self) -> Iterator[tuple[int, np.ndarray]]:
        """The k-th block, and the pieces that have so many, longest first."""
        order = np.argsort(-self.blocks, kind="stable")
        most = int(self.blocks[order[0]]) if len(order) else 0
        many = np.searchsorted(-self.blocks[order], -np.arange(1, most + 1), "right")
        return ((k, order[:n]) for k, n in enumerate(many))

    def look_up(self, behind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The vector in front of each piece, and the vector behind each block."""
        t, now = tables(), behind.astype(np.int64)
        held = np.zeros((len(self.codes), len(behind)) if self.shared else len(self.codes), np.int16)
        for k, which in self._active():
            block = self.first[which] + self.blocks[which] - 1 - k
            held[(block, which) if held.ndim == 2 else block] = now[which]
            now[which] = t.block[now[which], self.codes[block]]
        return now, held

    def trace(self, held: np.ndarray, states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The state behind each piece; per row insertions, action and state in front."""
        t, now = tables(), states.astype(np.int64)
        out = np.zeros((0 if self.shared else self.symbols.size, 3), np.int8)
        for k, which in self._active():
            block = self.first[which] + k
            after = held[(block, which) if held.ndim == 2 else block].astype(np.int64)
            vectors = [after]
            for j in range(BLOCK - 1, 0, -1):
                vectors.append(t.step[vectors[-1], self.symbols[block, j]])
            for j, vector in enumerate(reversed(vectors)):
                found = t.trace[vector, self.symbols[block, j], now[which]]
                if not self.shared:
                    out[block * BLOCK + j] = np.column_stack([found[:, :2], now[which]])
                now[which] = found[:, 2]
        return now, out


# ---- rows, places and parts ---------------------------------------------------------------


def _initial(role: Column) -> Column:
    """0, 1, 2 for s, u, a; 3 for all others and the empty role."""
    at = F.position(F.substring(role, 1, 1), F.lit(INITIALS)) - 1
    return F.when((F.length(role) == 0) | (at < 0), 3).otherwise(at)


def slim_rows(
    rows: DataFrame, conversation: str, turn: str, role: str, text: str, keep: list[str]
) -> DataFrame:
    """`row`, at, conv, turn, role, text, and what the symbols need; numbered for good."""
    role_ = F.coalesce(rows[role].cast("string"), F.lit(" "))
    text_ = F.coalesce(rows[text].cast("string"), F.lit(" "))
    plain = rows.select(
        F.struct(*[rows[c] for c in keep]).alias("row"),
        rows[conversation].alias("conv"),
        rows[turn].alias("turn"),
        role_.alias("role"),
        text_.alias("text"),
    )
    last = F.right(F.rtrim("text", F.lit(BLANK_CHARACTERS)), F.lit(1))
    marked = plain.select(
        "*",
        F.sha2(F.col("text").cast("binary"), 256).alias("tie"),
        _initial(F.col("role")).cast("tinyint").alias("initial"),
        F.when(last == "", 2).when(last.isin(".", "!", "?"), 0).otherwise(1).cast("tinyint").alias("fault"),
        F.monotonically_increasing_id().alias("at"),
    )
    return written(marked, "turns")


def placed_rows(numbered: DataFrame) -> DataFrame:
    """Slim rows with `place`, the order of all rows, and `again`, true for repeats."""
    same = F.to_json(F.struct("conv", "role", "tie"), {"ignoreNullFields": "false"})
    slim = numbered.select(
        "at", "conv", "turn", "role", "tie", "initial", "fault",
        F.unhex(F.sha2(same.cast("binary"), 256)).alias("same"),
    )
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("tie"), F.asc("at")]
    out = ranked(slim, *order).withColumnRenamed("rank", "place")
    out = written(out.select("place", "at", "conv", "initial", "fault", "same"), "places")
    seen = out.groupBy("same").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    seen = written(seen.where("n > 1"), "repeats")
    later = hot_join(out.select("same", "place"), seen, "same", "n", out.count()).where("place > first")
    return out.drop("same").join(later.select("place", F.lit(True).alias("again")), "place", "left")


def packed_parts(placed: DataFrame, part_rows: int) -> DataFrame:
    """One row per part: its first place, symbols, initials, whether rows begin a conversation.

    A part also sees the rows on both sides of it: `left` and `right` say that its first and
    last conversation go on there.
    """
    part = F.floor(F.col("place") / part_rows).cast("bigint")
    fault = F.when(F.col("fault") == 2, 2).when(F.col("again"), 3).otherwise(F.col("fault"))
    own = placed.select("place", "conv", "initial", fault.cast("tinyint").alias("fault"), part.alias("part"))
    edge = F.col("place") % part_rows
    near = F.array_compact(
        F.array(
            F.col("part"),
            F.when((edge == 0) & (F.col("part") > 0), F.col("part") - 1),
            F.when(edge == part_rows - 1, F.col("part") + 1),
        )
    )
    spread = own.withColumn("part", F.explode(near))
    conv = placed.schema["conv"]
    schema = T.StructType([
        *(field(n, k) for n, k in (
            ("part", "bigint"), ("place", "bigint"), ("symbols", "binary"), ("faults", "binary"),
            ("initials", "binary"), ("begins", "binary"), ("left", "boolean"), ("right", "boolean"),
        )),
        T.StructField("first_conv", conv.dataType), T.StructField("last_conv", conv.dataType),
    ])

    def pack(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place").combine_chunks()
        this = rows.column("part")[0].as_py()
        place = rows.column("place").to_numpy()
        lo, hi = np.searchsorted(place, [this * part_rows, (this + 1) * part_rows])
        convs = rows.column("conv").combine_chunks()
        codes = convs.dictionary_encode(null_encoding="encode").indices.to_numpy()
        same = np.append(False, codes[1:] == codes[:-1])  # as the row before
        if lo == hi:  # only rows of its neighbours
            return schema_table([])
        initial, fault = (rows.column(c).to_numpy().astype(np.uint8) for c in ("initial", "fault"))
        symbols = np.where(fault >= 2, GOES, initial + 4 * (fault == 1)).astype(np.uint8)
        begins = ~same
        begins[lo] = True
        # What is in front of the first row counts for the pair of initials.
        before = initial[lo - 1] if lo and same[lo] else 255
        return schema_table([(
            this, int(place[lo]), symbols[lo:hi].tobytes(), fault[lo:hi].tobytes(),
            bytes([before]) + initial[lo:hi].tobytes(), begins[lo:hi].tobytes(),
            bool(lo and same[lo]), bool(hi < len(place) and same[hi]),
            convs[lo].as_py(), convs[hi - 1].as_py(),
        )])

    arrow = to_arrow_schema(schema)

    def schema_table(rows: list[tuple]) -> pa.Table:
        columns = list(zip(*rows)) if rows else [[] for _ in arrow]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return written(spread.groupBy("part").applyInArrow(pack, schema), "parts")


def _pieces(row: dict) -> Pieces:
    symbols = np.frombuffer(row["symbols"], np.uint8).astype(np.int64)
    return Pieces(symbols, np.flatnonzero(np.frombuffer(row["begins"], bool)))


def _each(parts: DataFrame, work, fields: list[tuple[str, str]]) -> DataFrame:
    """The rows that `work` makes of each part, one part at a time."""
    schema = T.StructType([f if isinstance(f, T.StructField) else field(*f) for f in fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                columns = work(batch.slice(i, 1).to_pylist()[0])
                if columns is not None:
                    made = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow)]
                    yield pa.RecordBatch.from_arrays(made, schema=arrow)

    return parts.mapInArrow(run, schema)


def _open(row: dict, pieces: Pieces, work) -> list | None:
    """conv, part, first, last and `work` of the pieces that go on in other parts."""
    last = len(pieces.blocks) - 1
    out = []
    if row["left"] or (row["right"] and last == 0):
        out.append((row["first_conv"], row["part"], True, last == 0, work(0).tolist()))
    if row["right"] and last > 0:
        out.append((row["last_conv"], row["part"], False, True, work(last).tolist()))
    return list(zip(*out)) if out else None


def _chain(maps: DataFrame, start: int, down: bool, name: str) -> DataFrame:
    """(part, first, last, name): what stands at the end of each open piece that comes first.

    `maps` has conv, part, first, last (its place in the part) and an array that gives for what is at one end what is at the other.
    The pieces of a conversation stream through one task; there is one per part.
    """
    parts = int(maps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = F.desc("part") if down else F.asc("part")
    spread = maps.repartition(parts, "conv").sortWithinPartitions("conv", order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = (), start
        for batch in batches:
            found = []
            for conv, leads in zip(batch.column("conv").to_pylist(), batch.column("leads").to_pylist()):
                if held != (conv,):
                    held, now = (conv,), start
                found.append(now)
                now = leads[now]
            kept = [batch.column(c) for c in ("part", "first", "last")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found, pa.int32())], names=["part", "first", "last", name]
            )

    return spread.mapInArrow(run, f"part bigint, first boolean, last boolean, {name} int")


def edits(
    rows: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    keep: list[str] | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Every row as `row`, with conv, place, role, text, and what its repair does.

    fault (0 none, 1 cut off, 2 blank, 3 repeat), illegal (the pair with the row before),
    inserts (rows put in front), action (Keep, Delete, Rerole by initial), state (of the
    pattern, in front of the insertions) and tail (rows put behind a conversation's last row).
    """
    bounded_batches(rows.sparkSession)
    keep = list(rows.columns if keep is None else keep)
    numbered = slim_rows(rows, conversation, turn, role, text, keep)
    placed = written(placed_rows(numbered), "placed")
    parts = packed_parts(placed, part_rows)
    conv = T.StructField("conv", placed.schema["conv"].dataType)
    leads = [conv, ("part", "bigint"), ("first", "boolean"), ("last", "boolean"), ("leads", "array<int>")]

    def vectors(row: dict):
        pieces = _pieces(row)
        every = np.arange(len(tables().vectors))
        return _open(row, pieces, lambda i: pieces.only(i, len(every)).look_up(every)[0])

    def states(row: dict):
        pieces = _pieces(row)
        every = np.arange(STATES)

        def one(i: int) -> np.ndarray:
            piece = pieces.only(i, STATES)
            end = row["behind"] if i == len(pieces.blocks) - 1 else 0
            return piece.trace(piece.look_up(np.full(STATES, end))[1], every)[0]

        return _open(row, pieces, one)

    parts = parts.join(_chain(_each(parts, vectors, leads), 0, True, "behind").where("last").drop("first", "last"), "part", "left")
    parts = written(parts.fillna(0, "behind"), "vectors")
    parts = parts.join(_chain(_each(parts, states, leads), 0, False, "state").where("first").drop("first", "last"), "part", "left")

    def traced(row: dict):
        pieces = _pieces(row)
        end = np.zeros(len(pieces.blocks), np.int64)
        begin = end.copy()
        end[-1], begin[0] = row["behind"], row["state"]
        exits, letters = pieces.trace(pieces.look_up(end)[1], begin)
        tail = np.zeros(len(pieces.at), np.int8)
        last = np.append(np.flatnonzero(np.frombuffer(row["begins"], bool))[1:], len(tail)) - 1
        tail[last] = tables().ends[exits]
        if row["right"]:
            tail[-1] = 0
        initials = np.frombuffer(row["initials"], np.uint8)
        follows = ~np.frombuffer(row["begins"], bool)
        follows[0] = row["left"]
        legal = _LEGAL[np.minimum(initials[:-1], 3), initials[1:]]
        return [
            pa.array(row["place"] + np.arange(len(tail)), pa.int64()),
            pa.array(np.frombuffer(row["faults"], np.uint8), pa.int8()),
            pa.array(follows & ~legal),
            *(pa.array(letters[pieces.at, k], pa.int8()) for k in range(3)),
            pa.array(tail, pa.int8()),
        ]

    found = _each(parts.fillna(0, "state"), traced, EDITS)
    action = F.substring(F.lit(ACTIONS), F.col("action") + 1, F.lit(1)).alias("action")
    found = found.select(*[action if n == "action" else n for n, _ in EDITS])
    whole = found.join(placed.select("place", "at", "conv"), "place")
    return whole.join(numbered.select("row", "at", "role", "text"), "at").drop("at")


#: Pairs of initials that may follow each other.
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True

EDITS = [
    ("place", "bigint"), ("fault", "tinyint"), ("illegal", "boolean"), ("inserts", "tinyint"),
    ("action", "tinyint"), ("state", "tinyint"), ("tail", "tinyint"),
]


def repaired(edited: DataFrame) -> DataFrame:
    """The rows after repair: conv, place, part (their order), role, text; inserted ones empty."""
    user_first = F.col("state") != 2

    def puts(count: Column, user: Column) -> Column:
        def one(k: Column) -> Column:
            role = F.when((k % 2 == 1) == user, "user").otherwise("assistant")
            return F.struct(role.alias("role"), F.lit("").alias("text"))

        return F.when(count > 0, F.transform(F.sequence(F.lit(1), count), one)).otherwise(F.array())

    before = F.col("inserts").cast("int")
    next_user = F.when(before % 2 == 0, user_first).otherwise(~user_first)
    row_role = F.when(F.col("action") == "K", F.col("role")).otherwise(
        F.when(next_user, "user").otherwise("assistant")
    )
    own = F.when(F.col("action") == "D", F.array()).otherwise(
        F.array(F.struct(row_role.alias("role"), F.col("text").alias("text")))
    )
    # Behind a conversation's last row: after a user only an assistant is wanting, else both.
    after = puts(F.col("tail").cast("int"), F.col("tail") != 1)
    all_rows = F.concat(puts(before, user_first), own, after)
    out = edited.select("conv", "place", F.posexplode(all_rows).alias("part", "r"))
    return out.select("conv", "place", "part", "r.role", "r.text")


def summary(edited: DataFrame) -> DataFrame:
    """Per conversation: faults, illegal pairs, cost, audit and the digest of the repaired rows."""
    parts = int(edited.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    columns = ["conv", "place", "fault", "illegal", "inserts", "action", "state", "tail", "role", "text"]
    spread = edited.select(columns).repartition(parts, "conv").sortWithinPartitions("conv", "place")
    numbers = ["blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([
        spread.schema["conv"], *(field(n, "bigint") for n in numbers),
        field("audit", "string"), field("repaired_sha256", "string"),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kind = None, None

        def finished(convs: list[_Running]) -> pa.RecordBatch:
            rows = [(c.conv, *c.numbers, "".join(c.audit), c.digest.hexdigest()) for c in convs]
            kinds = [kind, *[pa.int64()] * len(numbers), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=schema.names)

        for batch in batches:
            kind, done = batch.column("conv").type, []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held.conv != row[0]:
                    done += [held] if held else []
                    held = _Running(row[0])
                held.add(*row[2:])
            if done:
                yield finished(done)
        if held:
            yield finished([held])

    return spread.mapInArrow(run, schema)


class _Running:
    """What is known of a conversation after some of its rows."""

    def __init__(self, conv):
        self.conv, self.numbers, self.audit = conv, [0] * 5, []
        self.digest, self.some = sha256(), False

    def put(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.some else "").encode() + f"{role}:{text}".encode())
        self.some = True

    def insert(self, count: int, state: int) -> int:
        for _ in range(count):
            self.put(NEXT_ROLE[state], "")
            state = NEXT_STATE[state]
        self.audit.append("I" * count)
        self.numbers[4] += INSERT * count
        return state

    def add(self, fault, illegal, inserts, action, state, tail, role, text) -> None:
        for k, found in enumerate((fault == 2, fault == 3, fault == 1, illegal)):
            self.numbers[k] += found
        state = self.insert(inserts, state)
        self.audit.append(action)
        if action == "D":
            self.numbers[4] += DELETE
        else:
            self.numbers[4] += CUT_OFF * (fault == 1) + REROLE * (action == "R")
            self.put(role if action == "K" else NEXT_ROLE[state], text)
            initial = INITIALS.find(role[:1]) if action == "K" else 0
            state = kept_state(initial, state) if action == "K" else NEXT_STATE[state]
        self.insert(tail, state)


def gaps(rows: DataFrame, conversation: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv, gaps): turns that are missing between the first and the last, per conversation."""
    number = rows[turn].cast("decimal(20,0)")
    turns = rows.select(rows[conversation].alias("conv"), number.alias("turn"))
    # Distinct first, so that no conversation's turns meet in one task.
    span = turns.distinct().groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("bigint").alias("gaps")
    )
    return span.select("conv", F.coalesce("gaps", F.lit(0)).cast("bigint").alias("gaps"))


def damaged(
    rows: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Rows with faults by the CRC of conversation and turn: dropped, emptied, cut, twice, another role."""

    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(named(conversation), F.lit(":"), named(turn)).cast("binary")) % 20
    said = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate(named(text), ".!?", ""))
    marked = rows.withColumn("_fault", fault).where("_fault <> 0").withColumns({
        role: F.when(F.col("_fault") == 4, "user").otherwise(named(role)),
        text: said.otherwise(named(text)),
    })
    twice = F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1))
    return marked.withColumn("_copy", F.explode(twice)).drop("_fault", "_copy")
