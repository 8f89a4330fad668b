"""Near-duplicate lines by an exact set-similarity join.

A line is the set of its tokens (runs of other than white space, A-Z
lower-cased), ordered by rarity. Rarity is the number of times that tokens of
one of ``RARITY_BUCKETS`` hash buckets occur in all lines, in classes, so that the
table has a fixed size; ties go by hash. Any order shared by all lines gives the
same result, a good one makes the join small.

Two lines of similarity t share a token among the first n - ceil(t n) + 1 of
each (prefix filter); their sizes differ by a factor of t at most (length
filter); the places of each shared token leave room for the overlap that t
asks for (positional filter); and so does the number of tokens that the prefixes
share. What passes is compared in full, each line with the first line of its tokens
to begin with, so that a crowd of similar lines is not compared pair by pair.

Tokens are made by numpy where the text is read: for the rarity, for the
prefixes, and twice for the full sets of lines in candidate pairs. Only prefixes
and those sets travel, as numbers; a text is never shuffled for the join.

Equal token sets are one class before the join, and later rows of a class go
without any comparison. Sets of so few tokens that one more token makes them too
unlike (three or fewer at 0.8) are similar to equal ones only, and need no more
than their class. A token in the prefixes of very many classes is a join
key whose partitions adaptive execution splits.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from mercaflow.llm.memory import giving_back
from mercaflow.llm.storage import scratch, stored
from mercaflow.llm.words import LOWER, MULTIPLIERS, U64, mix, row_slices, words_of

THRESHOLD = 0.8
RARITY_BUCKETS = 1 << 17
# Counts of rarity travel in blocks of this many buckets.
BLOCK = 1 << 13
# Columns of a set's signature, 64 bits each. One alone is full for sets of a hundred tokens.
SIGNATURE = ("bits", "bits_2")
# Bits that hold a class of rarity: counts of up to 2**63.
CLASS_BITS = 8
# Places of the filter of lines in candidate pairs.
FILTER_BITS = 1 << 22
# Bytes of line numbers up to which they are broadcast to the texts, and those of
# a document beside its numbers; beyond that the texts are shuffled to them.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 64
# Bytes of text that are worked on at a time.
PART_BYTES = 1 << 20
_NEWLINE = 10


class _Lines:
    """Ordered token sets of the lines of some rows: the sets of all lines stand
    one behind another in ``keys``, line ``i`` from ``starts[i]`` to
    ``starts[i + 1]``; ``row`` and ``number`` tell where it stands."""

    def __init__(self, row: np.ndarray, number: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> None:
        self.row, self.number, self.keys, self.starts = row, number, keys, starts
        self.sizes = np.diff(starts)

    def signatures(self) -> list[np.ndarray]:
        """``64 * len(SIGNATURE)`` bits of each set, 64 at a time: each of its tokens sets one."""
        if not len(self.sizes):
            return [np.zeros(0, dtype=np.int64) for _ in SIGNATURE]
        bit = U64(1) << (self.keys & U64(63))
        part = (self.keys >> U64(6)) % U64(len(SIGNATURE))
        ors = (np.bitwise_or.reduceat(np.where(part == U64(i), bit, U64(0)), self.starts[:-1]) for i in range(len(SIGNATURE)))
        return [x.view(np.int64) for x in ors]

    def prints(self) -> np.ndarray:
        """A hash of each set."""
        if not len(self.sizes):
            return np.zeros(0, dtype=np.int64)
        summed = np.add.reduceat(mix(self.keys.copy()), self.starts[:-1])
        return mix(summed + self.sizes.astype(U64) * MULTIPLIERS[0]).view(np.int64)


def _tokens_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """First row, and the hash, the row and the line number of each token, of some
    rows at a time."""
    for start, part in row_slices(column, PART_BYTES):
        lengths = pc.fill_null(pc.binary_length(part), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for words in words_of(part, LOWER):
            offsets = np.concatenate([[0], np.cumsum(lengths[words.first : words.last])])
            breaks = np.flatnonzero(words.data == _NEWLINE)
            rows = words.rows()
            number = np.searchsorted(breaks, words.starts) - np.searchsorted(breaks, offsets)[rows]
            yield start + words.first, words.hashes, rows, number


def _lines_of(column: pa.Array, classes: np.ndarray) -> Iterator[_Lines]:
    """The lines of a text column that have a token, some rows at a time."""
    for first, hashes, rows, number in _tokens_of(column):
        rank = classes[(hashes & U64(RARITY_BUCKETS - 1)).astype(np.int64)].astype(U64)
        keys = (rank << U64(64 - CLASS_BITS)) | (hashes >> U64(CLASS_BITS))
        order = np.lexsort((keys, number, rows))
        rows, number, keys = rows[order], number[order], keys[order]
        fresh = np.ones(len(keys), dtype=bool)
        same_line = (rows[1:] == rows[:-1]) & (number[1:] == number[:-1])
        fresh[1:] = ~(same_line & (keys[1:] == keys[:-1]))
        begins = np.ones(len(keys), dtype=bool)
        begins[1:] = ~same_line
        starts = np.flatnonzero(begins[fresh])
        at = np.flatnonzero(begins)
        yield _Lines(first + rows[at], number[at], keys[fresh], np.append(starts, int(fresh.sum())))


def _counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(RARITY_BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, hashes, _, _ in _tokens_of(batch.column("text")):
            counts += np.bincount((hashes & U64(RARITY_BUCKETS - 1)).astype(np.int64), minlength=RARITY_BUCKETS)
    blocks = np.flatnonzero(counts.reshape(-1, BLOCK).any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(blocks), pa.array([counts[b * BLOCK : (b + 1) * BLOCK].tobytes() for b in blocks], pa.binary())],
        ["block", "counts"],
    )


def _adding(frame: pa.Table) -> pa.Table:
    counts = np.zeros(BLOCK, dtype=np.int64)
    for value in frame["counts"]:
        counts += np.frombuffer(value.as_buffer(), dtype=np.int64)
    return pa.table({"block": frame["block"].slice(0, 1), "counts": pa.array([counts.tobytes()], pa.binary())})


def _rarity(docs: DataFrame) -> np.ndarray:
    """The class of each hash bucket, 0 for the rarest: four classes for every
    doubling of the count."""
    counted = docs.select("text").mapInArrow(giving_back(_counting), "block long, counts binary")
    summed = counted.groupBy("block").applyInArrow(_adding, "block long, counts binary")
    counts = np.zeros(RARITY_BUCKETS, dtype=np.int64)
    for row in summed.toLocalIterator():
        counts[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = np.frombuffer(row["counts"], dtype=np.int64)
    return (4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)


def _prefixes(classes: np.ndarray, percent: int) -> Callable:
    """``doc_id``, ``line_no``, ``print``, ``n``, its signature and ``prefix`` (short
    hashes of the rarest tokens, of which sets that are similar share one; none of
    a set that is similar to equal ones only) of each line with a token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in _lines_of(batch.column("text"), classes):
                n = lines.sizes
                length = np.where(100 * n < percent * (n + 1), 0, n + (-percent * n) // 100 + 1)
                within = np.arange(len(lines.keys)) - np.repeat(lines.starts[:-1], n)
                chosen = lines.keys[within < np.repeat(length, n)]
                short = (mix(chosen.copy()) >> U64(32)).astype(np.uint32).view(np.int32)
                offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array(lines.row)),
                        pa.array(lines.number.astype(np.int32)),
                        pa.array(lines.prints()),
                        pa.array(n.astype(np.int32)),
                        *map(pa.array, lines.signatures()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(short)),
                    ],
                    ["doc_id", "line_no", "print", "n", *SIGNATURE, "prefix"],
                )

    return run


def _full_sets(classes: np.ndarray, filter_bits: np.ndarray) -> Callable:
    """``print`` and ``tokens`` of lines that the filter lets through, once for
    each set of some rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lines in _lines_of(batch.column("text"), classes):
                prints = lines.prints()
                distinct, at = np.unique(prints, return_index=True)
                at = at[_is_set(filter_bits, distinct)]
                n = lines.sizes[at]
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                within = np.arange(offsets[-1]) - np.repeat(offsets[:-1], n)
                keys = lines.keys[np.repeat(lines.starts[:-1][at], n) + within]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[at]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64)))],
                    ["print", "tokens"],
                )

    return run


def _is_set(filter_bits: np.ndarray, prints: np.ndarray) -> np.ndarray:
    places = prints.view(U64) & U64(FILTER_BITS - 1)
    return (filter_bits[(places >> U64(3)).astype(np.int64)] >> (places & U64(7)).astype(np.uint8)) & 1 == 1


def _filter_of(prints: DataFrame) -> np.ndarray:
    """A bitmap of fixed size of ``prints``, which lets some others through on
    very large inputs."""
    place = F.col("print").bitwiseAND(F.lit(FILTER_BITS - 1))
    bits = F.expr(f"shiftleft(1L, cast(print & {FILTER_BITS - 1} & 63 as int))")
    words = prints.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(bits).alias("bits"))
    out = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    for row in words.toLocalIterator():
        out[row["word"]] = row["bits"]
    return out.view(np.uint8)


def _signature(df: DataFrame) -> list[str]:
    return [c for c in SIGNATURE if c in df.columns]


def _entries(classes: DataFrame, *columns: str) -> DataFrame:
    """The prefix tokens of ``classes``, with ``n`` and the token's place in one number."""
    columns = (*_signature(classes), *columns)
    placed = classes.select(
        "print", *columns, F.posexplode("prefix").alias("place", "token"), F.col("n").cast("long").alias("n")
    )
    n_place = F.shiftleft("n", 32).bitwiseOR(F.col("place").cast("long")).alias("n_place")
    return placed.select("token", "print", *columns, n_place)


def _fits(percent: int, signature: list[str]) -> tuple[Column, Column]:
    """Whether the two sets of a shared token pass the length and positional
    filters and their signatures leave room (a bit that one set has and the other
    lacks stands for a token that they don't share), and how many tokens their
    prefixes must share: the prefix that ends earlier in the order has all shared
    tokens up to its end in both prefixes, and behind it there are no more than the
    rest of its set."""
    n_a, n_b = (F.shiftright(f"n_place_{x}", 32) for x in "ab")
    place_a, place_b = (F.col(f"n_place_{x}").bitwiseAND(F.lit((1 << 32) - 1)) for x in "ab")
    # Tokens up to and from the shared one; the first shared token decides, and passes if the pair does.
    most = 1 + F.least(place_a, place_b) + F.least(n_a - place_a, n_b - place_b) - 1
    needed = F.ceil(percent * (n_a + n_b) / (100 + percent))
    only_a, only_b = (
        sum(F.bit_count(F.col(f"{c}_{x}").bitwiseAND(F.bitwise_not(f"{c}_{y}"))) for c in signature) for x, y in ("ab", "ba")
    )
    sizes = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    room = (n_a - only_a >= needed) & (n_b - only_b >= needed)
    rest = F.ceil(percent * F.greatest(n_a, n_b) / 100) - 1
    return (F.col("print_a") != F.col("print_b")) & sizes & (most >= needed) & room, needed - rest


def _led(entries: DataFrame, percent: int) -> DataFrame:
    """For each class at most one earlier one, ``print_b``, that is likely similar:
    of the first classes of its prefix tokens, the one with most of them, if that is
    half of them. Linear in the entries, however many classes share a token."""
    signature = _signature(entries)
    columns = ("print", *signature, "n_place")
    leader = F.struct(*columns)
    leaders = entries.groupBy("token").agg(F.min_by(leader, "first").alias("leader"))
    a = entries.select("token", *(F.col(c).alias(f"{c}_a") for c in columns))
    b = leaders.select("token", *(F.col(f"leader.{c}").alias(f"{c}_b") for c in columns))
    fits, _ = _fits(percent, signature)
    counted = a.join(b, "token").filter(fits).groupBy("print_a", "print_b").agg(
        F.count(F.lit(1)).alias("shared"), F.max(F.shiftright("n_place_a", 32)).alias("n")
    )
    likely = counted.filter(2 * F.col("shared") >= F.col("n") - F.ceil(percent * F.col("n") / 100) + 1)
    return likely.groupBy("print_a").agg(F.max_by("print_b", F.struct("shared", "print_b")).alias("print_b"))


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of an open class and any other that pass all filters. A pair of two
    open classes comes once. Both sides of open classes are one shuffle, which
    Spark reuses as they have equal columns; closed classes meet open ones only."""
    signature = _signature(entries)
    columns = ("print", *signature, "n_place")
    fits, least = _fits(percent, signature)

    def side(kind: str, x: str) -> DataFrame:
        return entries.filter(kind).select("token", *(F.col(c).alias(f"{c}_{x}") for c in columns))

    both_open = side("open", "a").join(side("open", "b"), "token").filter(fits & (F.col("print_a") < F.col("print_b")))
    with_closed = side("open", "a").join(side("not open", "b"), "token").filter(fits)
    met = [pairs.select("print_a", "print_b", least.alias("least")) for pairs in (both_open, with_closed)]
    each = met[0].union(met[1]).groupBy("print_a", "print_b").agg(
        F.count(F.lit(1)).alias("shared"), F.max("least").alias("least")
    )
    return each.filter("shared >= least").select("print_a", "print_b")


def _verified(
    docs: DataFrame, pairs: DataFrame, rarity: np.ndarray, percent: int, folder: str | None
) -> DataFrame:
    """Those of ``pairs`` (``print_a``, ``print_b``) with a Jaccard similarity of
    ``percent`` or more, by their full sets."""
    pairs = stored(pairs, "line_pairs", folder)
    ends = pairs.select(F.col("print_a").alias("print")).union(pairs.select("print_b")).distinct()
    # Full sets only of lines in a candidate pair; the rest stays where it is.
    full_sets = giving_back(_full_sets(rarity, _filter_of(ends)))
    found = docs.select("text").mapInArrow(full_sets, "print long, tokens array<long>")
    sets = found.join(ends, "print", "left_semi").groupBy("print").agg(F.any_value("tokens").alias("tokens"))
    sets = stored(sets, "line_sets", folder)
    both = pairs.join(sets.toDF("print_a", "tokens_a"), "print_a").join(sets.toDF("print_b", "tokens_b"), "print_b")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    union = F.size("tokens_a") + F.size("tokens_b") - shared
    return both.filter(100 * shared >= percent * union).select("print_a", "print_b")


def _later_lines(
    docs: DataFrame, classes: DataFrame, rarity: np.ndarray, percent: int, folder: str | None
) -> DataFrame:
    """``first`` of the classes that are similar to an earlier one.

    A class needs one such class only. Most have one among the first classes of
    their tokens; they are settled by that, and a crowd of similar lines takes as
    many comparisons as it has lines. All that are still open are compared with
    every class that the filters leave.
    """
    with scratch(docs.sparkSession, "led") as own:
        led = _verified(docs, _led(_entries(classes, "first"), percent), rarity, percent, own)
        settled = stored(led.select(F.col("print_a").alias("print")), "settled_lines", folder)
    flagged = classes.join(settled.withColumn("closed", F.lit(True)), "print", "left")
    flagged = flagged.withColumn("open", F.col("closed").isNull()).drop("closed")
    similar = _verified(docs, _candidates(_entries(flagged, "open"), percent), rarity, percent, folder)
    first = classes.select("print", "first")
    pairs = similar.join(first.toDF("print_a", "first_a"), "print_a").join(first.toDF("print_b", "first_b"), "print_b")
    later = pairs.select(F.greatest("first_a", "first_b").alias("later"))
    return settled.join(first, "print").select("first").union(later)


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD, folder: str | None = None) -> DataFrame:
    """``doc_id`` and ``line_no`` (from 0) of the lines to remove: those with
    tokens that are as similar as ``threshold`` to a line before them, by
    ``doc_id`` and line number; blank lines stay. A line counts whether or not
    it is itself removed. Equal sets are told by a 64-bit hash. Long texts are
    taken whole, a batch of them at a time. Rows are read from tables below
    ``folder``, if given."""
    percent = round(100 * threshold)
    docs = docs.select("doc_id", "text").filter("doc_id is not null")
    rarity = _rarity(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, line_no int, print long, n int, {', '.join(f'{c} long' for c in SIGNATURE)}, prefix array<int>"
    with scratch(docs.sparkSession, "lines") as own:
        lines = stored(docs.mapInArrow(giving_back(_prefixes(rarity, percent)), schema), "lines", own)
        classes = stored(
            lines.groupBy("print").agg(
                F.min(F.struct("doc_id", "line_no")).alias("first"),
                F.count(F.lit(1)).alias("n_lines"),
                F.any_value("n").alias("n"),
                *(F.any_value(c).alias(c) for c in SIGNATURE),
                F.any_value("prefix").alias("prefix"),
            ),
            "line_classes",
            folder,
        )
        repeated = classes.filter("n_lines > 1").select("print", "first")
        members = lines.select("doc_id", "line_no", "print").join(repeated, "print")
        copies = members.filter(F.struct("doc_id", "line_no") != F.col("first")).select("doc_id", "line_no")
        copies = stored(copies, "line_copies", folder)
    later = _later_lines(docs, classes, rarity, percent, folder).select("first.*")
    return copies.union(later)


def dedup_lines(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with all their columns, their ``text`` without the
    lines of ``removed_lines``, and ``n_lines`` and ``n_removed_lines``.

    The first line of each group of similar ones stays. Null and empty texts
    stay as they are, and so do rows without ``doc_id``. Lines of rows that
    repeat a ``doc_id`` go by their number for all of these rows. A text all of
    whose lines go becomes empty. Columns that clash with the two new ones are
    replaced.
    """
    with scratch(docs.sparkSession, "line_sets") as folder:
        gone = removed_lines(docs, threshold, folder).groupBy("doc_id").agg(F.collect_set("line_no").alias("_gone"))
        gone = stored(gone, "gone_lines")
    size = F.count(F.lit(1)) * ROW_BYTES + F.coalesce(F.sum(F.size("_gone")), F.lit(0)) * 4
    if gone.agg(size).first()[0] <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    # The lines are a column of their own, so that they are split once a row.
    joined = docs.join(gone, "doc_id", "left").withColumn("_lines", F.split("text", "\n"))
    places = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    kept = F.transform(places, lambda i: F.get("_lines", i))
    untouched = F.col("text").isNull() | F.col("_gone").isNull()
    out = joined.withColumns(
        {
            "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("_lines")).cast("long"),
            "n_removed_lines": F.when(untouched, 0).otherwise(F.size("_lines") - F.size(places)).cast("long"),
            "text": F.when(untouched, F.col("text")).otherwise(F.array_join(kept, "\n")),
        }
    )
    return out.select(*docs.columns, *(c for c in ("n_lines", "n_removed_lines") if c not in docs.columns))
