"""Repeated passages, found by matching statistics against suffix automata.

A window is ``window`` consecutive words. It repeats if the same words also
begin somewhere in a document of smaller ``doc_id``; every word of a repeating
window is removed.

One automaton over the corpus would have to be broadcast whole, and would grow
with it. So the corpus is cut into reference shards by content: each window is
known by its anchor, the least hash of ``ANCHOR_WORDS`` consecutive words within
it, which equal windows share. Consecutive windows with one anchor are a
context. Contexts of an anchor that only one document has are settled. Equal
contexts of several documents belong to the first of them. What is left, the
different contexts of anchors that several documents have, is dealt to shards
by anchor. A task builds the suffix automaton of its shard, each state with
the smallest document it occurs in, and streams the shard's contexts for
matching statistics: a window repeats if its state, followed up to the window's
length, has a smaller document.
"""
from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mercaflow.llm.storage import partitions, stored
from mercaflow.llm.words import PLAIN, Rolling, Words, as_long, words_of

WINDOW = 50
ANCHOR_WORDS = 5
# Contexts of one automaton; an anchor with more is compared chunk by chunk.
CHUNK = 2000

CONTEXT_SCHEMA = "doc_id long, anchor long, context long, first long, last long"


def _minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _contexts(words: Words, window: int) -> tuple[np.ndarray, ...]:
    """Row, anchor, context hash, first and last window of each context."""
    count, width = len(words.hashes), window - ANCHOR_WORDS + 1
    if count < window:
        return (np.zeros(0, dtype=np.int64),) * 5
    rolling = Rolling(words.hashes)
    at = np.arange(count - ANCHOR_WORDS + 1)
    least = _minima(rolling.runs(at, at + ANCHOR_WORDS), width)
    row = words.rows()
    start = np.arange(count - window + 1)
    inside = row[start] == row[start + window - 1]
    fresh = inside.copy()
    fresh[1:] &= (least[1:] != least[:-1]) | ~inside[:-1]
    first = np.flatnonzero(fresh)
    closing = inside.copy()
    closing[:-1] &= (least[1:] != least[:-1]) | ~inside[1:]
    last = np.flatnonzero(closing)
    context = rolling.runs(first, last + window)
    begin = words.bounds[:-1][row[first]]
    return row[first], as_long(least[first]), as_long(context), first - begin, last - begin


def _finding(window: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for words in words_of(batch.column("text"), PLAIN):
                row, *rest = _contexts(words, window)
                own = ids.take(pa.array(words.first + row))
                yield pa.RecordBatch.from_arrays(
                    [own, *map(pa.array, rest)], ["doc_id", "anchor", "context", "first", "last"]
                )

    return find


def _cutting(window: int):
    """The words of the asked contexts, as hashes, with all their places in the
    row: a context that a document holds several times is one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asked = batch.column("doc_id").to_pylist(), batch.column("asked").to_pylist()
            for words in words_of(batch.column("text"), PLAIN):
                out = []
                for i in range(words.last - words.first):
                    own = words.hashes[words.bounds[i] : words.bounds[i + 1]]
                    places: dict[tuple[int, bytes], set[int]] = {}
                    for x in asked[words.first + i]:
                        run = own[x["first"] : x["last"] + window]
                        # A row that shares its id with the asked one may hold other words.
                        if len(run) == x["last"] + window - x["first"] and as_long(Rolling(run).runs(np.array([0]), np.array([len(run)])))[0] == x["context"]:
                            places.setdefault((x["anchor"], run.tobytes()), set()).add(x["first"])
                    out += [(anchor, ids[words.first + i], sorted(firsts), run) for (anchor, run), firsts in places.items()]
                if out:
                    columns = list(zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(pa.array(c, type=pa.int64()) for c in columns[:2]),
                            pa.array(columns[2], type=pa.list_(pa.int64())),
                            pa.array(columns[3], type=pa.binary()),
                        ],
                        ["anchor", "doc_id", "firsts", "words"],
                    )

    return cut


class SuffixAutomaton:
    """Of several sequences; every state knows the smallest owner of an
    occurrence."""

    def __init__(self) -> None:
        self.length, self.link, self.next, self.owner = [0], [-1], [{}], [None]

    def add(self, sequence: list[int], owner: int) -> None:
        last = 0
        for word in sequence:
            last = self._extend(last, word, owner)

    def _new(self, length: int, link: int, following: dict[int, int], owner: int | None) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        self.owner.append(owner)
        return len(self.length) - 1

    def _split(self, state: int, target: int, word: int) -> int:
        """A state for the words of ``target`` that end a run into it from
        ``state``, apart from its longer ones."""
        copy = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]), self.owner[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int, owner: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            if self.length[known] != self.length[last] + 1:
                known = self._split(last, known, word)
            if self.owner[known] is None or owner < self.owner[known]:
                self.owner[known] = owner
            return known
        state = self._new(self.length[last] + 1, 0, {}, owner)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = state
            at = self.link[at]
        if at >= 0:
            target = self.next[at][word]
            self.link[state] = target if self.length[target] == self.length[at] + 1 else self._split(at, target, word)
        return state

    def settle(self) -> None:
        """Give every state the smallest owner of the states it is a suffix of."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            link, owner = self.link[state], self.owner[state]
            if link > 0 and (self.owner[link] is None or owner < self.owner[link]):
                self.owner[link] = owner

    def repeats(self, sequence: list[int], owner: int, window: int) -> Iterator[int]:
        """Starts of the windows that a smaller owner has."""
        state = matched = 0
        for i, word in enumerate(sequence):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            if matched >= window:
                while self.length[self.link[state]] >= window:
                    state = self.link[state]
                    matched = self.length[state]
                if self.owner[state] < owner:
                    yield i - window + 1


def _matching(window: int):
    """Repeating windows of the contexts of one shard. Rows that only stream
    (``reference`` false) are not put into the automaton."""

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["anchor", "chunk", "doc_id"])
        spans = []
        for _, group in frame.groupby(["anchor", "chunk"], sort=False):
            sequences = [np.frombuffer(w, dtype=np.int64).tolist() for w in group["words"]]
            owners = group["doc_id"].tolist()
            automaton = SuffixAutomaton()
            for sequence, owner, reference in zip(sequences, owners, group["reference"]):
                if reference:
                    automaton.add(sequence, owner)
            automaton.settle()
            for sequence, owner, firsts in zip(sequences, owners, group["firsts"]):
                starts = np.fromiter(automaton.repeats(sequence, owner, window), dtype=np.int64)
                if len(starts):
                    cut = np.flatnonzero(np.diff(starts) > window)
                    begins = starts[np.concatenate([[0], cut + 1])]
                    ends = starts[np.concatenate([cut, [len(starts) - 1]])] + window
                    spans += [(owner, first + b, first + e) for first in firsts for b, e in zip(begins, ends)]
        return pd.DataFrame(spans, columns=["doc_id", "begin", "end"])

    return match


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``begin`` and ``end`` of runs of words whose windows all
    repeat; runs may overlap. Texts without ``doc_id`` take no part."""
    texts = docs.select("doc_id", "text").filter("doc_id is not null")
    contexts = stored(texts.mapInArrow(_finding(window), CONTEXT_SCHEMA), "contexts")
    forms = contexts.groupBy("anchor", "context").agg(
        F.min("doc_id").alias("owner"), F.max("doc_id").alias("latest")
    )
    shared = forms.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n_forms"), F.min("owner").alias("a"), F.max("latest").alias("z")
    ).filter("a < z").select("anchor", "n_forms")
    owners = stored(forms.join(shared, "anchor").select("anchor", "context", "owner", "n_forms"), "forms")
    members = stored(contexts.join(owners, ["anchor", "context"]), "members")
    copies = members.filter("doc_id > owner").select("doc_id", F.col("first").alias("begin"), (F.col("last") + window).alias("end"))

    asked = members.filter("doc_id = owner and n_forms > 1").groupBy("doc_id").agg(
        F.collect_list(F.struct("anchor", "context", "first", "last")).alias("asked")
    )
    cut = texts.join(asked, "doc_id").mapInArrow(_cutting(window), "anchor long, doc_id long, firsts array<long>, words binary")
    cut = stored(cut.dropDuplicates(), "cut")
    # An anchor of many forms is met chunk by chunk: every form streams past the
    # references of its own and of all other chunks.
    sizes = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    own = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    dealt = cut.join(sizes, "anchor").withColumn("chunks", chunks).withColumn("own", own)
    dealt = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = dealt.withColumn("reference", F.col("own") == F.col("chunk"))
    shard = F.pmod(F.xxhash64("anchor", "chunk"), F.lit(8 * partitions(docs.sparkSession)))
    matched = dealt.select("anchor", "chunk", "doc_id", "firsts", "words", "reference", shard.alias("shard")).groupBy(
        "shard"
    ).applyInPandas(_matching(window), "doc_id long, begin long, end long")
    return copies.union(matched)


def _removing():
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, ends = batch.column("begins"), batch.column("ends")
            for words in words_of(batch.column("text"), PLAIN):
                texts, removed = [], []
                data = words.data.tobytes()
                for i in range(words.last - words.first):
                    low, high = words.bounds[i], words.bounds[i + 1]
                    gone = np.zeros(high - low + 1, dtype=np.int64)
                    if begins[words.first + i].is_valid:
                        for edges, step in ((begins, 1), (ends, -1)):
                            edge = np.array(edges[words.first + i].as_py(), dtype=np.int64)
                            np.add.at(gone, np.minimum(edge, high - low), step)
                    kept = np.flatnonzero(np.cumsum(gone[:-1]) == 0) + low
                    removed.append(int(high - low - len(kept)))
                    if removed[-1]:
                        texts.append(b" ".join(data[a:b] for a, b in zip(words.starts[kept], words.ends[kept])))
                    elif high > low:
                        texts.append(b" ".join(data[words.starts[low] : words.ends[high - 1]].split()))
                    else:
                        texts.append(b"")
                part = batch.slice(words.first, words.last - words.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(words.bounds)),
                        pa.array(removed, type=pa.int64()),
                        pa.array([t.decode() for t in texts], type=pa.string()),
                    ],
                    ["doc_id", "n_words", "n_removed", "kept_text"],
                )

    return remove


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_text`` (kept words joined
    by single spaces) for each row of ``docs`` (``doc_id``, ``text``).

    Null and empty texts have no words. A document shorter than the window
    loses nothing. Rows that repeat a ``doc_id`` are one document as far as
    other documents are concerned, and lose the union of their runs that fits
    their length. A row without ``doc_id`` keeps all its words. Other columns
    are not looked at.
    """
    spans = repeated_spans(docs, window).groupBy("doc_id").agg(
        F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")
    )
    rows = docs.select("doc_id", "text").join(spans, "doc_id", "left")
    return rows.mapInArrow(_removing(), "doc_id long, n_words long, n_removed long, kept_text string")
