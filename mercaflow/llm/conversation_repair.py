"""Repair of conversation structure by a run-length min-plus dynamic program.

A conversation is a sequence of symbols, the role's initial and the fault of each
row. Edits turn it into an optional system row and pairs of a user and an
assistant row, or into nothing. The automaton of that pattern has four states, so
a row is a 4 x 4 min-plus matrix of least costs, a run of equal symbols a power of
it, put together from cached binary powers, and a piece of a conversation the
product of its runs. Matrices compose, so long conversations are worked on in
pieces of ``PIECE`` rows at most:

1. rows get a global order and a fault each, and pieces a string of symbols;
2. each piece is multiplied out; the few matrices of a conversation are chained
   from its end, which gives the cost that is left behind every piece;
3. each piece unrolls its choices, for each state it may be entered in, and the
   right ones are chained from the conversation's start.

Only what the result itself holds for a conversation comes together in one task:
the audit, and the text as a stream (a digest reads it in order), never as a
list.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from mercaflow.llm.storage import stored

#: Rows of a piece, as bits of the row number.
PIECE_BITS = 16
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
SPACES = " \t\n\x0b\x0c\r"
# A symbol is a letter for the initial (s, u, a or another) and the
# fault (none, truncated, one that requires deletion).
INITIALS, SYMBOLS = "sua", "abcdefghijkl"
FAULTS = ("blank", "duplicate", "truncated")

# States: nothing yet, after system, after user, after assistant.
STATES = range(4)
FAR = 1 << 60
_AFTER_INSERT = (2, 2, 3, 2)
_AFTER_KEEP = {0: {0: 1}, 1: {0: 2, 1: 2, 3: 2}, 2: {2: 3}, 3: {}}
_ROLE_OF_STATE = {2: "user", 3: "assistant"}
_END = (0, 2 * INSERT, INSERT, 0)

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def _apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(a[i][k] + v[k] for k in STATES) for i in STATES)


def _choices(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """Edits that take a row of ``symbol`` in ``state``: letter, cost, next state."""
    initial, fault = divmod(symbol, 3)
    found = [("D", DELETE, state)]
    if fault < 2:
        extra = TRUNCATED * fault
        if state in _AFTER_KEEP[initial]:
            found.append(("K", KEEP + extra, _AFTER_KEEP[initial][state]))
        found.append(("R", REROLE + extra, _AFTER_INSERT[state]))
    return found


@lru_cache(maxsize=None)
def _power(symbol: int, bit: int) -> Matrix:
    """The matrix of a run of ``2 ** bit`` rows."""
    if bit:
        half = _power(symbol, bit - 1)
        return _times(half, half)
    inserts = [[0 if i == j else FAR for j in STATES] for i in STATES]
    for i in STATES:
        state, cost = i, 0
        for _ in range(2):
            state, cost = _AFTER_INSERT[state], cost + INSERT
            inserts[i][state] = min(inserts[i][state], cost)
    row = [[FAR] * len(STATES) for _ in STATES]
    for i in STATES:
        for _, cost, after in _choices(symbol, i):
            row[i][after] = min(row[i][after], cost)
    return _times(tuple(map(tuple, inserts)), tuple(map(tuple, row)))


def _runs(symbols: str) -> list[tuple[int, int]]:
    """Symbol and length of each run of equal symbols."""
    codes = np.frombuffer(symbols.encode(), dtype=np.uint8) - ord(SYMBOLS[0])
    starts = np.flatnonzero(np.diff(codes, prepend=-1, append=-1))
    return list(zip(codes[starts[:-1]].tolist(), np.diff(starts).tolist()))


def _bits(length: int) -> list[int]:
    return [bit for bit in range(length.bit_length()) if length >> bit & 1]


def _before_run(symbol: int, length: int, after: Vector) -> Vector:
    for bit in _bits(length):
        after = _apply(_power(symbol, bit), after)
    return after


@lru_cache(maxsize=1 << 14)
def piece_matrix(symbols: str) -> Matrix:
    product = None
    for symbol, length in _runs(symbols):
        for bit in _bits(length):
            power = _power(symbol, bit)
            product = power if product is None else _times(product, power)
    return product


@lru_cache(maxsize=1 << 16)
def _letters(symbol: int, state: int, after: Vector) -> tuple[str, int]:
    """The ASCII-least cheapest edits up to and with those of one row."""
    before, letters = _apply(_power(symbol, 0), after), ""
    while True:
        options = [(x, cost + after[to], to) for x, cost, to in _choices(symbol, state)]
        options.append(("I", INSERT + before[_AFTER_INSERT[state]], _AFTER_INSERT[state]))
        letter, _, to = min(o for o in options if o[1] == before[state])
        letters, state = letters + letter, to
        if letter != "I":
            return letters, state


def _scaled(v: Vector) -> Vector:
    """Costs from the least: there are few such vectors, and choices depend on them only."""
    least = min(v)
    return tuple(x - least for x in v)


@lru_cache(maxsize=1 << 16)
def _step(symbol: int, after: Vector) -> Vector:
    return _scaled(_apply(_power(symbol, 0), after))


@lru_cache(maxsize=1 << 14)
def piece_edits(symbols: str, after: Vector, entry: int) -> tuple[str, int]:
    """Edits of a piece that is entered in ``entry``, and the state it is left in."""
    runs = _runs(symbols)
    behind = [after]
    for symbol, length in reversed(runs):
        behind.append(_scaled(_before_run(symbol, length, behind[-1])))
    letters, state = [], entry
    for (symbol, length), last in zip(runs, reversed(behind[:-1])):
        steps = [last]
        for _ in range(length - 1):
            steps.append(_step(symbol, steps[-1]))
        for vector in reversed(steps):
            some, state = _letters(symbol, state, vector)
            letters.append(some)
    return "".join(letters), state


def _tail(state: int) -> str:
    return "I" * (_END[state] // INSERT)


def _mapped(df: DataFrame, each: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """``each`` of all rows, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [out for row in batch.to_pylist() for out in each(row)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    fields = df.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(fields)
    kinds, names = arrow.types, arrow.names
    return df.mapInArrow(run, schema)


def _key(conv_id: Column) -> Column:
    """A conversation's key, never null."""
    return F.coalesce(F.concat(F.lit("v"), conv_id.cast("string")), F.lit("n"))


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows with their place ``seq`` in a global order by conversation and turn."""
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", _key(F.col("conv_id")).alias("conv"), "turn", role.alias("role"), text.alias("text"))
    digest = F.unhex(F.sha2(F.concat_ws(":", F.length("role").cast("string"), "role", "text"), 256))
    rows = rows.withColumn("digest", digest).orderBy("conv", F.col("turn").asc_nulls_first(), "digest")
    return stored(rows.withColumn("seq", F.monotonically_increasing_id()), "turns")


def _with_faults(rows: DataFrame) -> DataFrame:
    """``conv``, ``seq``, ``turn``, the first ``fault`` and the ``symbol`` of each row."""
    firsts = rows.groupBy("conv", "digest").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.filter("n > 1").drop("n")
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    small = rows.select(
        "conv", "digest", "seq", "turn",
        F.substring("role", 1, 1).alias("initial"),
        (trimmed == "").alias("blank"),
        (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    known = small.join(firsts, ["conv", "digest"], "left")
    fault = F.when(F.col("blank"), "blank").when(F.col("seq") > F.col("first"), "duplicate").when(F.col("cut"), "truncated")
    known = known.withColumn("fault", fault)
    kind = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 1).otherwise(2)
    place = F.instr(F.lit(INITIALS), F.col("initial"))
    initial = F.when((F.col("initial") == "") | (place == 0), len(INITIALS)).otherwise(place - 1)
    symbol = F.substring(F.lit(SYMBOLS), 3 * initial + kind + 1, F.lit(1))
    return known.select("conv", "seq", "turn", "fault", symbol.alias("symbol"))


def _pieces(symbols: DataFrame) -> DataFrame:
    """``conv``, ``piece``, its ``seqs`` and the string of its ``symbols``."""
    piece = F.shiftright("seq", PIECE_BITS).alias("piece")
    ordered = F.array_sort(F.collect_list(F.struct("seq", "symbol")))
    found = symbols.groupBy("conv", piece).agg(ordered.alias("rows"))
    return stored(
        found.select("conv", "piece", F.col("rows.seq").alias("seqs"), F.array_join("rows.symbol", "").alias("symbols")),
        "pieces",
    )


def _illegal(symbols: str) -> int:
    initials = [symbol // 3 for symbol, length in _runs(symbols) for _ in range(min(length, 2))]
    legal = {(0, 1), (1, 2), (2, 1)}
    inside = sum(length - 2 for _, length in _runs(symbols) if length > 2)
    return inside + sum((a, b) not in legal for a, b in zip(initials, initials[1:]))


def _edits(pieces: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``audit``, ``cost`` and ``illegal`` of conversations; ``piece`` and ``audit`` of pieces."""

    def multiply(row: dict) -> Iterator[tuple]:
        text = row["symbols"]
        yield row["conv"], row["piece"], [x for r in piece_matrix(text) for x in r], _illegal(text), text[0] + text[-1]

    products = _mapped(
        pieces.select("conv", "piece", "symbols"),
        multiply,
        "conv string, piece long, matrix array<long>, illegal long, ends string",
    )
    chain = F.array_sort(F.collect_list(F.struct("piece", "matrix", "illegal", "ends")))

    def chained(row: dict) -> Iterator[tuple]:
        parts, after, illegal = row["chain"], _END, 0
        for i in reversed(range(len(parts))):
            part = parts[i]
            behind, matrix = after, [part["matrix"][4 * j : 4 * j + 4] for j in STATES]
            after = _apply(matrix, after)
            illegal += part["illegal"] + (_illegal(part["ends"][1] + parts[i + 1]["ends"][0]) if i + 1 < len(parts) else 0)
            first = i == 0
            yield (
                row["conv"], part["piece"], list(_scaled(behind)), first and len(parts) == 1,
                after[0] if first else None, illegal if first else None,
            )

    left = _mapped(
        products.groupBy("conv").agg(chain.alias("chain")),
        chained,
        "conv string, piece long, behind array<long>, alone boolean, cost long, illegal long",
    )

    def unroll(row: dict) -> Iterator[tuple]:
        entries = [0] if row["alone"] else STATES
        found = [piece_edits(row["symbols"], tuple(row["behind"]), entry) for entry in entries]
        yield row["conv"], row["piece"], row["cost"], row["illegal"], [x[0] for x in found], [x[1] for x in found]

    unrolled = _mapped(
        pieces.select("conv", "piece", "symbols").join(left, ["conv", "piece"]),
        unroll,
        "conv string, piece long, cost long, illegal long, audits array<string>, exits array<int>",
    )
    unrolled = stored(unrolled, "edits")
    chain = F.array_sort(F.collect_list(F.struct("piece", "exits")))

    def entered(row: dict) -> Iterator[tuple]:
        state = 0
        for i, part in enumerate(row["chain"]):
            entry, state = state, part["exits"][state]
            yield row["conv"], part["piece"], entry, _tail(state) if i + 1 == len(row["chain"]) else ""

    entries = _mapped(
        unrolled.groupBy("conv").agg(chain.alias("chain")), entered, "conv string, piece long, entry int, tail string"
    )
    chosen = unrolled.join(entries, ["conv", "piece"]).select(
        "conv", "piece", "cost", "illegal", F.get("audits", F.col("entry")).alias("audit"), "tail"
    )
    chosen = stored(chosen, "chosen_edits")
    parts = F.array_sort(F.collect_list(F.struct("piece", F.concat("audit", "tail").alias("audit"))))
    audits = chosen.groupBy("conv").agg(
        F.max("cost").alias("cost"), F.max("illegal").alias("illegal"), F.array_join(parts["audit"], "").alias("audit")
    )
    return audits, chosen.select("conv", "piece", "audit")


def _edited(rows: DataFrame, pieces: DataFrame, audits: DataFrame) -> DataFrame:
    """Rows with their ``edits``, conversations whole in a task and in order."""
    each = pieces.select("conv", "piece", "seqs").join(audits, ["conv", "piece"])
    edits = F.arrays_zip(F.col("seqs").alias("seq"), F.regexp_extract_all("audit", F.lit("I*[DKR]"), F.lit(0)).alias("edits"))
    each = each.select(F.explode(edits).alias("row")).select("row.seq", "row.edits")
    joined = rows.select("conv", "conv_id", "seq", "role", "text").join(each, "seq")
    return joined.repartition("conv").sortWithinPartitions("conv", "seq")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Key, id, role, text and edit of repaired rows, one by one; role is None
    where a conversation ends."""
    conv, conv_id, state = None, None, 0

    def end() -> Iterator[tuple]:
        nonlocal state
        for _ in _tail(state):
            state = _AFTER_INSERT[state]
            yield conv, conv_id, _ROLE_OF_STATE[state], "", "I"
        yield conv, conv_id, None, None, None

    for batch in batches:
        for row in batch.to_pylist():
            if row["conv"] != conv:
                if conv is not None:
                    yield from end()
                conv, conv_id, state = row["conv"], row["conv_id"], 0
            for letter in row["edits"]:
                if letter == "D":
                    continue
                if letter == "K":
                    place = INITIALS.find(row["role"][:1])
                    state = _AFTER_KEEP[place][state]
                    yield conv, conv_id, row["role"], row["text"], letter
                else:
                    state = _AFTER_INSERT[state]
                    yield conv, conv_id, _ROLE_OF_STATE[state], row["text"] if letter == "R" else "", letter
    if conv is not None:
        yield from end()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest, lines, found = hashlib.sha256(), 0, []
    for conv, _, role, text, _ in _repaired(batches):
        if role is None:
            found.append((conv, digest.hexdigest()))
            digest, lines = hashlib.sha256(), 0
        else:
            digest.update((("\n" if lines else "") + f"{role}:{text}").encode())
            lines += 1
        if len(found) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["conv", "repaired_sha256"])
            found = []
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], ["conv", "repaired_sha256"])


def repaired_turns(turns: DataFrame) -> DataFrame:
    """The rows that the cheapest edits leave of ``turns``: ``conv_id``,
    ``position`` (from 0), ``role``, ``text`` and ``edit`` (K, R or I)."""
    rows = _ordered(turns)
    pieces = _pieces(_with_faults(rows))
    kind = turns.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, position = [], 0
        names = ["conv_id", "position", "role", "text", "edit"]
        kinds = [arrow, pa.int64(), pa.string(), pa.string(), pa.string()]
        for _, conv_id, role, text, edit in _repaired(batches):
            if role is None:
                position = 0
                continue
            held.append((conv_id, position, role, text, edit))
            position += 1
            if len(held) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), kinds)], names)

    schema = f"conv_id {kind.simpleString()}, position long, role string, text string, edit string"
    return _edited(rows, pieces, _edits(pieces)[1]).mapInArrow(run, schema)


def repair(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """What repairing each conversation of ``turns`` (``conv_id``, ``turn``,
    ``role``, ``text``) finds and does, one row for each ``conv_id`` of
    ``conversations`` (by default of ``turns``): ``gaps``, ``blank``,
    ``duplicate``, ``truncated`` and ``illegal`` count what is wrong, ``cost`` and
    ``audit`` are the cheapest edits, ``repaired_sha256`` is the digest of the
    repaired ``role:text`` lines.

    Rows go by turn, null turns first; rows of one turn by a digest of role and
    text, so equal rows are adjacent and all but the first are duplicates. Null
    roles and texts are one space, a null ``conv_id`` is a conversation of its own.
    Roles with an initial other than s, u or a are never kept as they are.
    Conversations without rows have zeros, an empty audit and the digest of
    nothing. Texts of any length are streamed. Other columns are not looked at; an
    empty table gives no rows.
    """
    rows = _ordered(turns)
    faults = stored(_with_faults(rows), "faults")
    pieces = _pieces(faults)
    audits, of_pieces = _edits(pieces)
    digests = _edited(rows, pieces, of_pieces).mapInArrow(_digests, "conv string, repaired_sha256 string")
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    counts = faults.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *(F.count_if(F.col("fault") == x).alias(x) for x in FAULTS)
    )
    found = counts.join(audits, "conv").join(digests, "conv")
    every = (conversations if conversations is not None else turns).select("conv_id").distinct()
    every = every.withColumn("conv", _key(F.col("conv_id")))
    zero = F.lit(0).cast("long")
    return every.join(found, "conv", "left").select(
        "conv_id",
        *(F.coalesce(x, zero).alias(x) for x in ("gaps", *FAULTS, "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
