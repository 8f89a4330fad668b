"""Benchmark decontamination with suffix arrays of the training text.

Tasks cut the documents into shards of some megabytes and build a word suffix
array of each: prefix doubling, to the depth of the longest benchmark item, of
all positions whose word the benchmark has (no other position can begin a
match). Every suffix of every item is then searched in the array, word by word
and all suffixes at once, which yields the occurrences of each window and the
longest verbatim match.

The benchmark is the stated query set. It is hashed in blocks of at most
``BLOCK_BYTES`` of text (or one item, if that is longer), and only a block is
broadcast at a time; documents pass through one narrow stage per block.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mercaflow.llm.memory import giving_back
from mercaflow.llm.words import ALPHANUMERIC, Rolling, Words, words_of

WINDOW = 10
BLOCK_BYTES = 32 << 20
SHARD_WORDS = 1 << 20


@dataclass
class TestSet:
    """Suffixes of a block of benchmark items."""

    vocabulary: np.ndarray
    words: np.ndarray  # as numbers from 1 within the vocabulary
    suffix_end: np.ndarray  # for each word, the end of its item
    items: list[str | None]
    item_of: np.ndarray
    bounds: np.ndarray
    window_start: np.ndarray  # one position for each distinct window
    window_length: np.ndarray
    window_items: list[np.ndarray]
    longest: int


def _test_set(ids: pa.Array, texts: pa.Array, window: int) -> TestSet:
    parts = list(words_of(texts, ALPHANUMERIC))
    hashes = np.concatenate([p.hashes for p in parts])
    sizes = np.concatenate([np.diff(p.bounds) for p in parts])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    vocabulary = np.unique(hashes)
    item_of = np.repeat(np.arange(len(sizes)), sizes)
    counts = np.where(sizes >= window, sizes - window + 1, np.minimum(sizes, 1))
    row = np.repeat(np.arange(len(sizes)), counts)
    start = bounds[:-1][row] + np.arange(len(row)) - (np.cumsum(counts) - counts)[row]
    length = np.minimum(sizes, window)[row]
    _, first, which = np.unique(Rolling(hashes).runs(start, start + length), return_index=True, return_inverse=True)
    order = np.argsort(which, kind="stable")
    groups = np.split(row[order], np.flatnonzero(np.diff(which[order])) + 1) if len(order) else []
    return TestSet(
        vocabulary,
        np.searchsorted(vocabulary, hashes) + 1,
        bounds[1:][item_of],
        [None if x is None else str(x) for x in ids.to_pylist()],
        item_of,
        bounds,
        start[first],
        length[first],
        [np.unique(g) for g in groups],
        int(sizes.max(initial=0)),
    )


def suffix_array(text: np.ndarray, depth: int, highest: int) -> np.ndarray:
    """Positions of non-zero words of ``text`` in the order of what follows
    them, compared to ``depth`` words or the next zero. Words go to ``highest``."""
    positions = np.flatnonzero(text)
    bits = max(1, int(highest).bit_length())
    width = max(1, min(63 // bits, depth))
    padded = np.concatenate([text, np.zeros(width, dtype=np.int64)])
    key = np.zeros(len(positions), dtype=np.int64)
    for i in range(width):
        key = (key << bits) | padded[positions + i]
    order = np.argsort(key, kind="stable")
    array, key = positions[order], key[order]
    rank = np.zeros(len(text) + 1, dtype=np.int64)
    fresh = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, dtype=bool)
    group = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), 0)) if len(key) else key
    rank[array] = group + 1
    while width < depth and len(array):
        shared = ~fresh | ~np.append(fresh[1:], True)
        slots = np.flatnonzero(shared)
        if not len(slots):
            break
        members = array[slots]
        key = group[slots] * (len(array) + 1) + rank[np.minimum(members + width, len(text))]
        order = np.argsort(key, kind="stable")
        array[slots], key = members[order], key[order]
        fresh[slots] = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(fresh, np.arange(len(array)), 0))
        rank[array] = group + 1
        width *= 2
    return array


def _bound(text, array, at, value, low, high, right: bool) -> np.ndarray:
    """Binary search in the ranges ``low`` to ``high``, all at once."""
    low, high = low.copy(), high.copy()
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        word = text[array[middle] + at]
        up = word <= value[open_] if right else word < value[open_]
        low[open_[up]] = middle[up] + 1
        high[open_[~up]] = middle[~up]
        open_ = open_[low[open_] < high[open_]]
    return low


@dataclass
class Found:
    low: np.ndarray  # range of each window in the suffix array
    high: np.ndarray
    length: np.ndarray  # longest match of each test suffix, and one place
    place: np.ndarray
    array: np.ndarray


def _search(text: np.ndarray, test: TestSet) -> Found:
    array = suffix_array(text, max(1, test.longest), len(test.vocabulary))
    text = np.concatenate([text, np.zeros(test.longest + 1, dtype=np.int64)])
    count = len(test.words)
    low, high = np.zeros(count, dtype=np.int64), np.full(count, len(array))
    length, place = np.zeros(count, dtype=np.int64), np.full(count, -1)
    window_low, window_high = np.zeros((2, len(test.window_start)), dtype=np.int64)
    active = np.arange(count) if len(array) else np.zeros(0, dtype=np.int64)
    for depth in range(test.longest):
        active = active[active + depth < test.suffix_end[active]]
        value = test.words[active + depth]
        left = _bound(text, array, depth, value, low[active], high[active], False)
        right = _bound(text, array, depth, value, left, high[active], True)
        low[active], high[active] = left, right
        gone = left >= right
        active = active[~gone]
        length[active], place[active] = depth + 1, array[low[active]]
        done = np.flatnonzero(test.window_length == depth + 1)
        alive = done[length[test.window_start[done]] == depth + 1]
        window_low[alive], window_high[alive] = low[test.window_start[alive]], high[test.window_start[alive]]
        if not len(active):
            break
    return Found(window_low, window_high, length, place, array)


def _shards(words: Words, test: TestSet) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts to index, and the index in ``words`` of each of their positions.
    Rows are set apart by a zero; a long run of rows is cut with an overlap
    that no match can cross unseen."""
    place = np.minimum(np.searchsorted(test.vocabulary, words.hashes), max(0, len(test.vocabulary) - 1))
    known = test.vocabulary[place] == words.hashes if len(test.vocabulary) else np.zeros(len(place), dtype=bool)
    number = np.where(known, place + 1, 0)
    count = len(number)
    text = np.zeros(count + len(words.bounds), dtype=np.int64)
    at = np.arange(count) + words.rows()
    text[at] = number
    origin = np.full(len(text), -1)
    origin[at] = np.arange(count)
    overlap = max(1, test.longest) - 1
    for first in range(0, max(1, len(text) - overlap), SHARD_WORDS):
        last = min(len(text), first + SHARD_WORDS + overlap)
        yield text[first:last], origin[first:last]


def _scan(words: Words, test: TestSet) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which words are hit, and the items of each row."""
    hit = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    row = words.rows()
    pairs = []
    for text, origin in _shards(words, test):
        found = _search(text, test)
        count = found.high - found.low
        which = np.repeat(np.arange(len(count)), count)
        slot = np.repeat(found.low - (np.cumsum(count) - count), count) + np.arange(len(which))
        begin = origin[found.array[slot]]
        np.add.at(hit, begin, 1)
        np.add.at(hit, begin + test.window_length[which], -1)
        pairs.append(np.unique(row[begin] * max(1, len(count)) + which))
    pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, dtype=np.int64)
    windows = max(1, len(test.window_start))
    items: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * (words.last - words.first)
    if len(pairs):
        rows = pairs // windows
        for group in np.split(pairs, np.flatnonzero(np.diff(rows)) + 1):
            lists = [test.window_items[w] for w in group % windows]
            items[int(group[0] // windows)] = np.unique(np.concatenate(lists))
    return np.cumsum(hit[:-1]) > 0, items


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
SCAN_SCHEMA = (
    "doc_id long, text string, n_words long, spans array<struct<begin: long, end: long>>, items array<string>"
)


def _spans(hit: np.ndarray) -> list[dict[str, int]]:
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [{"begin": int(b), "end": int(e)} for b, e in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def _scanning(broadcast):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = broadcast.value
        for batch in batches:
            for words in words_of(batch.column("text"), ALPHANUMERIC):
                part = batch.slice(words.first, words.last - words.first)
                hit, found = _scan(words, test)
                spans, items = part.column("spans").to_pylist(), part.column("items").to_pylist()
                for i in np.flatnonzero([len(f) > 0 for f in found]):
                    own = hit[words.bounds[i] : words.bounds[i + 1]]
                    for span in spans[i]:
                        own[span["begin"] : span["end"]] = True
                    spans[i] = _spans(own)
                    names = {test.items[k] for k in found[i]} - {None}
                    items[i] = sorted(names.union(items[i]))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text"),
                        pa.array(np.diff(words.bounds)),
                        pa.array(spans, type=pa.list_(_SPAN)),
                        pa.array(items, type=pa.list_(pa.string())),
                    ],
                    ["doc_id", "text", "n_words", "spans", "items"],
                )

    return scan


def _test_sets(benchmark: DataFrame, window: int) -> Iterator[TestSet]:
    benchmark = benchmark.select("item_id", "text").filter("text is not null")
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_BYTES))
    for block in range(blocks):
        part = benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        if len(part):
            yield _test_set(part["item_id"], part["text"], window)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each row of ``docs`` (``doc_id``, ``text``): ``n_words``, ``spans`` of
    words inside an occurrence of a benchmark window, and the sorted ``items``
    (ids as text) whose windows occur.

    A window is ``window`` consecutive words of an item (``item_id``, ``text``);
    an item of fewer words is one window; one without words has none. A null
    text has no words. Rows that repeat a ``doc_id`` stay rows of their own.
    Items that share an id count once; one without id hits words but is not
    listed. Other columns are not looked at. Empty tables give no hits.
    """
    spark = docs.sparkSession
    nothing = {
        "n_words": F.lit(0).cast("long"),
        "spans": F.array().cast("array<struct<begin: long, end: long>>"),
        "items": F.array().cast("array<string>"),
    }
    scanned = docs.select("doc_id", "text").withColumns(nothing)
    empty = TestSet(*(np.zeros(0, dtype=np.int64),) * 3, [], *(np.zeros(0, dtype=np.int64),) * 4, [], 0)
    for test in list(_test_sets(benchmark, window)) or [empty]:
        scanned = scanned.mapInArrow(giving_back(_scanning(spark.sparkContext.broadcast(test))), SCAN_SCHEMA)
    return scanned.drop("text")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, unchanged, in
    all their columns. Rows are judged as in ``benchmark_hits``."""
    kept = docs
    for test in _test_sets(benchmark, window):
        kept = kept.mapInArrow(giving_back(_filtering(docs.sparkSession.sparkContext.broadcast(test))), docs.schema)
    return kept


def _filtering(broadcast):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text"), ALPHANUMERIC):
                part = batch.slice(words.first, words.last - words.first)
                hit, _ = _scan(words, broadcast.value)
                bad = np.add.reduceat(np.append(hit, False).astype(np.int64), words.bounds[:-1])
                bad[np.diff(words.bounds) == 0] = 0
                yield part.filter(pa.array(bad == 0))

    return keep


def _longest(broadcast):
    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = broadcast.value
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for words in words_of(batch.column("text"), ALPHANUMERIC):
                row, out = words.rows(), []
                for text, origin in _shards(words, test):
                    found = _search(text, test)
                    for item in np.unique(test.item_of[found.length > 0]):
                        begin, end = test.bounds[item], test.bounds[item + 1]
                        best = int(begin + np.argmax(found.length[begin:end]))
                        place = int(origin[found.place[best]])
                        out.append(
                            {
                                "item_id": test.items[item],
                                "n_words": int(found.length[best]),
                                "item_word": int(best - begin),
                                "doc_id": ids[words.first + int(row[place])],
                                "doc_word": int(place - words.bounds[row[place]]),
                            }
                        )
                if out:
                    yield pa.RecordBatch.from_pylist(out)

    return longest


def longest_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """For each benchmark item that shares a word with a document: the longest
    verbatim match, ``n_words`` long, from ``item_word`` in the item and from
    ``doc_word`` in ``doc_id``; of several, one with the smallest ``doc_id``."""
    schema = "item_id string, n_words long, item_word long, doc_id long, doc_word long"
    matches = docs.sparkSession.createDataFrame([], schema)
    for test in _test_sets(benchmark, WINDOW):
        found = docs.select("doc_id", "text").mapInArrow(_longest(docs.sparkSession.sparkContext.broadcast(test)), schema)
        matches = matches.union(found)
    best = F.min(F.struct(-F.col("n_words"), "doc_id", "doc_word", "item_word")).alias("best")
    return matches.groupBy("item_id").agg(best).select(
        "item_id", (-F.col("best").col1).alias("n_words"), "best.item_word", "best.doc_id", "best.doc_word"
    )
