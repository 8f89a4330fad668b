"""Near-duplicate documents by a chosen-path set similarity join.

Every document is a set of word shingles, reduced to ``COORDINATES`` minwise
tokens. In each of ``trees`` independent trees, documents are branched by
minwise tokens at randomly selected coordinates: a node's documents that share
the token go to one child. A child with one document ends there. A child of up
to ``SMALL`` documents is compared exhaustively, by the share of equal minwise
tokens. Of a larger one, the documents that are like most of it, which branching
would hardly part, are compared with all of it, and the rest branches on.
Candidate pairs are confirmed on full shingle sets.

Documents with the same set are one class from the start, so that a group of
copies of any size is one row in the trees. A document leaves a node only when
it was compared with every other one there, and no row is dropped: what a tree
can miss is bounded by the number of trees (``recall`` in the README). Where many
pairs of a node are close, they are not listed: blocks of its documents meet with
their full sets, and pairs that confirmed links join already are passed over, as
they cannot change a component.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mercaflow.llm.components import connected_components
from mercaflow.llm.memory import giving_back
from mercaflow.llm.storage import partitions, scratch, stored
from mercaflow.llm.words import LOWER, U64, Rolling, Words, as_long, mix, words_of

COORDINATES = 128
TREES = 4
# Up to here, comparing a document with half of its node costs less than branching it.
SMALL = 2048
TINY = 32
TILE = 512
PROBES = 4
# A document of a large node this far below the threshold, in its likeness to the
# probes, is like most of the node.
CROWD_BELOW = 0.2
# Candidate pairs a document, beyond which those of a node are not listed.
LISTED = 16
# What one of two blocks that meet may hold.
BLOCK_DOCS = 8192
BLOCK_SHINGLES = 2_000_000
LOOKUPS = 1 << 20
# Estimates from 128 coordinates deviate by 0.035 at a similarity of 0.8.
CANDIDATE_BELOW = 0.12
# Bits that say which documents are in a candidate pair, in blocks of 32,768: a
# sketch of fixed size, which lets some others through on very large inputs.
FILTER_BLOCKS = 1024
_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=U64) * U64(0x9E3779B97F4A7C15))
_FACTORS, _TERMS = _SEEDS[:COORDINATES] | U64(1), _SEEDS[COORDINATES:]
NODE_SCHEMA = "key long, doc_id long, n_shingles long, sketch binary"
NODE_COLUMNS = ["key", "doc_id", "n_shingles", "sketch"]
FOUND_SCHEMA = f"{NODE_SCHEMA}, a long, b long, listed boolean"
FOUND_COLUMNS = [*NODE_COLUMNS, "a", "b", "listed"]


def shingle_sets(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row of ``words``, one row after the other,
    and where each row begins. A row of fewer words is one shingle."""
    rolling = Rolling(words.hashes)
    sizes = np.diff(words.bounds)
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    row = np.repeat(np.arange(len(sizes)), counts)
    firsts = np.cumsum(counts) - counts
    start = words.bounds[:-1][row] + np.arange(len(row)) - firsts[row]
    shingles = rolling.runs(start, start + np.minimum(sizes, width)[row])
    parts = [np.unique(shingles[a : a + n]) for a, n in zip(firsts, counts)]
    distinct = np.array([len(p) for p in parts], dtype=np.int64)
    return (
        np.concatenate(parts) if parts else np.zeros(0, dtype=U64),
        np.concatenate([[0], np.cumsum(distinct)]),
    )


def _sketches(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minwise tokens of each set, cut to 8 bits; all sets have members."""
    sketch = np.empty((len(starts), COORDINATES), dtype=np.uint8)
    for i in range(COORDINATES):
        least = np.minimum.reduceat(shingles * _FACTORS[i] + _TERMS[i], starts)
        sketch[:, i] = (mix(least) >> U64(56)).astype(np.uint8)
    return sketch


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], type=pa.binary())


def _summaries(width: int):
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for words in words_of(batch.column("text"), LOWER):
                shingles, bounds = shingle_sets(words, width)
                size = np.diff(bounds)
                full = np.flatnonzero(size)
                sums, mixed = np.zeros(len(size), dtype=U64), np.zeros(len(size), dtype=U64)
                sketches = np.zeros((len(size), COORDINATES), dtype=np.uint8)
                if len(full):
                    starts = bounds[:-1][full]
                    sums[full] = np.add.reduceat(mix(shingles), starts)
                    mixed[full] = np.add.reduceat(mix(shingles ^ _SEEDS[0]), starts)
                    sketches[full] = _sketches(shingles, starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(words.first, words.last - words.first),
                        pa.array(size),
                        pa.array(as_long(sums)),
                        pa.array(as_long(mixed)),
                        _binary(sketches),
                    ],
                    ["doc_id", "n_shingles", "print_a", "print_b", "sketch"],
                )

    return summarise


def _children(keys: np.ndarray, sketches: np.ndarray, fan: int) -> np.ndarray:
    """The ``fan``-th child of each node for its documents: a coordinate that
    the node selects, and the document's token there."""
    chosen = mix(keys.view(U64) * U64(2 * fan + 3))
    tokens = sketches[np.arange(len(keys)), (chosen % U64(COORDINATES)).astype(np.int64)]
    return as_long(mix(chosen ^ mix(tokens.astype(U64) + U64(1))))


def _sketch_matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.uint8).reshape(-1, COORDINATES)


def _roots(trees: int):
    def roots(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            sketches = _sketch_matrix(frame["sketch"])
            for tree in range(trees):
                root = np.full(len(frame), tree + 1, dtype=np.int64)
                keys = [_children(root, sketches, fan) for fan in (0, 1)]
                yield frame.assign(key=keys[0])
                yield frame.assign(key=keys[1])

    return roots


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).mean(axis=1)


def _fits(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether two set sizes allow the similarity."""
    return np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9


def _equal_tokens(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many tokens the documents of ``left`` share with those of ``right``;
    both hold a row for each coordinate."""
    equal = np.zeros((left.shape[1], right.shape[1]), dtype=np.uint8)
    same = np.empty(equal.shape, dtype=bool)
    for a, b in zip(left, right):
        np.equal(a[:, None], b[None, :], out=same)
        equal += same.view(np.uint8)
    return equal


def _close_pairs(
    sketches: np.ndarray, sizes: np.ndarray, threshold: float, border: int = 0
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows that may be similar, tile by tile, with their equal tokens:
    all pairs, or those of a row before ``border`` with a row from there on."""
    tokens = np.ascontiguousarray(sketches.T)
    least, n = (threshold - CANDIDATE_BELOW) * COORDINATES, len(sizes)
    for a in range(0, border or n, TILE):
        end = min(a + TILE, border or n)
        for b in range(border or a, n, TILE):
            equal = _equal_tokens(tokens[:, a:end], tokens[:, b : b + TILE])
            left, right = np.nonzero(equal >= least)
            count = equal[left, right]
            left, right = left + a, right + b
            fit = (left < right) & _fits(sizes[left], sizes[right], threshold)
            yield left[fit], right[fit], count[fit]


def _compare_small(threshold: float):
    """All pairs of each small node in a bucket of nodes: candidate pairs
    (``listed``), or the documents of a node with too many of these."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["key", "doc_id"])
        ids, sizes, sketches = frame["doc_id"].to_numpy(), frame["n_shingles"].to_numpy(), _sketch_matrix(frame["sketch"])
        found, crowds = [], []
        tiny = np.flatnonzero(frame["in_node"].to_numpy() <= TINY)
        keys = frame["key"].to_numpy()[tiny]
        for apart in range(1, TINY):
            at = np.flatnonzero(keys[apart:] == keys[:-apart])
            if not len(at):
                break
            left, right = tiny[at], tiny[at + apart]
            fit = _fits(sizes[left], sizes[right], threshold)
            left, right = left[fit], right[fit]
            near = _alike(sketches[left], sketches[right]) >= threshold - CANDIDATE_BELOW
            found.append(np.stack([ids[left[near]], ids[right[near]]], axis=1))
        larger = np.flatnonzero(frame["in_node"].to_numpy() > TINY)
        keys = frame["key"].to_numpy()[larger]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else larger
        for a, b in zip(starts, np.append(starts[1:], len(keys))):
            rows = larger[a:b]
            pairs, listed = [], 0
            for left, right, _ in _close_pairs(sketches[rows], sizes[rows], threshold):
                pairs.append(np.stack([ids[rows[left]], ids[rows[right]]], axis=1))
                listed += len(left)
                if listed > LISTED * len(rows):
                    crowds.append(rows)
                    break
            else:
                found += pairs
        pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), dtype=np.int64)
        pairs = pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]}).assign(key=0, doc_id=0, n_shingles=0, sketch=b"", listed=True)
        members = frame.iloc[np.concatenate(crowds) if crowds else []][NODE_COLUMNS].assign(a=0, b=0, listed=False)
        return pd.concat([pairs[FOUND_COLUMNS], members[FOUND_COLUMNS]])

    return compare


def _likeness(sketches: np.ndarray, others: pd.Series) -> np.ndarray:
    """Share of tokens equal to those of the other document in each row."""
    other = b"".join(x["sketch"] for x in others)
    return (sketches == np.frombuffer(other, dtype=np.uint8).reshape(-1, COORDINATES)).mean(axis=1)


def _mark_dense(threshold: float):
    """Whether each document is like most of its node, by a few random members."""

    def mark(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                sketches = _sketch_matrix(frame["sketch"])
                like = sum(_likeness(sketches, frame[f"probe{p}"]) for p in range(PROBES)) / PROBES
                yield frame[NODE_COLUMNS].assign(dense=like >= threshold - CROWD_BELOW)

    return mark


def _branch(threshold: float, steps: int):
    """The children of each document, ``steps`` branchings below."""

    def branch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rest in frames:
            if not len(rest):
                continue
            sketches, keys = _sketch_matrix(rest["sketch"]), rest["key"].to_numpy()
            for _ in range(steps):
                # 1 / threshold children in the mean, as many as a similar pair needs to stay together.
                second = (mix(keys.view(U64)) >> U64(32)).astype(np.float64) / 2**32 < 1 / threshold - 1
                rest = pd.concat([rest, rest[second]])
                keys = np.concatenate([_children(keys, sketches, 0), _children(keys[second], sketches[second], 1)])
                sketches = np.concatenate([sketches, sketches[second]])
            yield rest.assign(key=keys)[NODE_COLUMNS]

    return branch


def _marked(large: DataFrame, threshold: float, folder: str | None) -> DataFrame:
    member = F.struct("doc_id", "n_shingles", "sketch")
    probes = [F.min_by(member, F.xxhash64("doc_id", F.lit(p))).alias(f"probe{p}") for p in range(PROBES)]
    probed = large.join(large.groupBy("key").agg(*probes), "key")
    return stored(probed.mapInPandas(giving_back(_mark_dense(threshold)), f"{NODE_SCHEMA}, dense boolean"), "marked", folder)


def _candidates(sets: DataFrame, threshold: float, trees: int, folder: str | None) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs, and the documents of crowds: nodes in which the ``dense``
    ones are to be compared with all others."""
    spark = sets.sparkSession
    nodes = sets.select("doc_id", "n_shingles", "sketch").mapInPandas(
        giving_back(_roots(trees)), "doc_id long, n_shingles long, sketch binary, key long"
    )
    buckets = 8 * partitions(spark)
    # What is still large after the first branching is alike, and takes two at once.
    pairs, crowds, steps = None, None, 1
    while True:
        counts = nodes.groupBy("key").agg(F.count(F.lit(1)).alias("in_node")).filter("in_node > 1")
        alive = stored(nodes.join(counts, "key"), "nodes", folder)
        small = alive.filter(F.col("in_node") <= SMALL).withColumn("bucket", F.pmod("key", F.lit(buckets)))
        found = stored(small.groupBy("bucket").applyInPandas(_compare_small(threshold), FOUND_SCHEMA), "found", folder)
        listed = found.filter("listed").select("a", "b")
        members = found.filter("not listed").select(*NODE_COLUMNS, F.lit(True).alias("dense"))
        pairs = listed if pairs is None else pairs.union(listed)
        crowds = members if crowds is None else crowds.union(members)
        large = alive.filter(F.col("in_node") > SMALL).drop("in_node")
        if large.isEmpty():
            return pairs.distinct(), crowds
        marked = _marked(large, threshold, folder)
        dense = marked.filter("dense").select("key").distinct()
        crowds = crowds.union(marked.join(dense, "key", "left_semi").select(*NODE_COLUMNS, "dense"))
        nodes = stored(
            marked.filter("not dense").select(*NODE_COLUMNS).mapInPandas(giving_back(_branch(threshold, steps)), NODE_SCHEMA),
            "step",
            folder,
        )
        steps = 2


class _Sets:
    """Full sets of the rows of two blocks, looked up in one sorted array."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(x) for x in sets], dtype=np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        distinct, local = np.unique(np.concatenate(sets), return_inverse=True)
        self.stride = len(distinct)
        self.keys = np.sort(np.repeat(np.arange(len(sets)), self.sizes) * self.stride + local)

    def similar(self, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
        few = self.sizes[left] <= self.sizes[right]
        small, other = np.where(few, left, right), np.where(few, right, left)
        ends = np.cumsum(self.sizes[small])
        shared, a = np.zeros(len(left), dtype=np.int64), 0
        while a < len(left):
            done = ends[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(ends, done + LOOKUPS, "right")))
            sizes, firsts = self.sizes[small[a:b]], ends[a:b] - self.sizes[small[a:b]] - done
            pair = np.repeat(np.arange(a, b), sizes)
            place = np.arange(len(pair)) - firsts[pair - a] + self.starts[small[pair]]
            asked = self.keys[place] + (other[pair] - small[pair]) * self.stride
            at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
            shared[a:b] = np.add.reduceat(self.keys[at] == asked, firsts, dtype=np.int64)
            a = b
        # In hundredths, so that a similarity of exactly the threshold counts.
        return 100 * shared >= percent * (self.sizes[left] + self.sizes[right] - shared)


class _Joined:
    """Rows that links have joined, by a label of each group."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, left: np.ndarray, right: np.ndarray) -> list[int]:
        """Takes links, and returns the places of those that joined two groups."""
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = parent.get(parent[x], parent[x])
                x = parent[x]
            return x

        new = []
        for k, (a, b) in enumerate(zip(self.label[left].tolist(), self.label[right].tolist())):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
                new.append(k)
        if new:
            names, where = np.unique(self.label, return_inverse=True)
            self.label = np.array([root(x) for x in names.tolist()])[where]
        return new


def _crowd_links(threshold: float):
    """Confirmed links that join what is similar in two blocks of a crowd."""
    percent = round(100 * threshold)

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["part", "doc_id"])
        ids, dense, part = (frame[c].to_numpy() for c in ("doc_id", "dense", "part"))
        sets, joined, links = _Sets(frame["shingles"].tolist()), _Joined(len(ids)), [np.zeros((0, 2), dtype=np.int64)]
        border = 0
        if frame["low"].iloc[0] != frame["high"].iloc[0]:
            border = int((part == frame["low"].iloc[0]).sum())
            if border in (0, len(ids)):
                return pd.DataFrame({"a": links[0][:, 0], "b": links[0][:, 1]})
        for left, right, equal in _close_pairs(_sketch_matrix(frame["sketch"]), sets.sizes, threshold, border):
            open_ = np.flatnonzero(dense[left] | dense[right])
            # The likest pairs of each document come first, and ever more of them while none links it.
            open_, most = open_[np.argsort(-equal[open_].astype(np.int64), kind="stable")], 1
            while True:
                open_ = open_[joined.label[left[open_]] != joined.label[right[open_]]]
                if not len(open_):
                    break
                order = np.argsort(left[open_], kind="stable")
                _, first, counts = np.unique(left[open_][order], return_index=True, return_counts=True)
                taken = np.zeros(len(open_), dtype=bool)
                taken[order] = np.arange(len(open_)) - np.repeat(first, counts) < most
                now, open_ = open_[taken], open_[~taken]
                now = now[sets.similar(left[now], right[now], percent)]
                now = now[joined.add(left[now], right[now])]
                links.append(np.stack([ids[left[now]], ids[right[now]]], axis=1))
                most *= 2
        pairs = np.concatenate(links)
        return pd.DataFrame({"a": pairs.min(axis=1), "b": pairs.max(axis=1)})

    return link


def _links_of_crowds(crowds: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """Blocks of each crowd's documents meet in pairs, with their full sets."""
    blocks = F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n_shingles") / BLOCK_SHINGLES)
    sizes = crowds.groupBy("key").agg(F.ceil(blocks).cast("int").alias("blocks"))
    part = F.pmod(F.xxhash64("doc_id", "key"), F.col("blocks")).cast("int").alias("part")
    placed = crowds.join(sizes, "key").select("key", "doc_id", "sketch", "dense", "blocks", part)
    held = placed.join(full.filter(F.size("shingles") > 0), "doc_id")
    met = held.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"low": F.least("part", "met"), "high": F.greatest("part", "met")}).drop("met", "blocks")
    return met.groupBy("key", "low", "high").applyInPandas(_crowd_links(threshold), "a long, b long")


def _filter_bits(ids: DataFrame) -> np.ndarray:
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BLOCKS * 32768)) + 1
    blocks = ids.select(place.alias("place")).groupBy(F.bitmap_bucket_number("place").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    bits = np.zeros((FILTER_BLOCKS, 4096), dtype=np.uint8)
    for row in blocks.collect():
        bits[row["block"] - 1] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits.reshape(-1)


def _full_sets(width: int, broadcast):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = broadcast.value
        for batch in batches:
            place = batch.column("place").to_numpy()
            batch = batch.filter(pa.array((bits[place >> 3] >> (place & 7)) & 1 == 1))
            for words in words_of(batch.column("text"), LOWER):
                shingles, bounds = shingle_sets(words, width)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(as_long(shingles)))
                ids = batch.column("doc_id").slice(words.first, words.last - words.first)
                yield pa.RecordBatch.from_arrays([ids, lists], ["doc_id", "shingles"])

    return sets


def similar_pairs(
    docs: DataFrame, sets: DataFrame, width: int, threshold: float, trees: int = TREES, folder: str | None = None
) -> DataFrame:
    """Pairs ``a < b`` of the given distinct sets with a Jaccard similarity of
    ``threshold`` or more, confirmed on all shingles: of a crowd as many as join
    its documents, of the rest all. They are read from tables below ``folder``,
    if given."""
    pairs, crowds = _candidates(sets, threshold, trees, folder)
    pairs = stored(pairs, "pairs", folder)
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).union(crowds.select("doc_id"))
    bits = docs.sparkSession.sparkContext.broadcast(_filter_bits(ids))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BLOCKS * 32768)).alias("place")
    texts = docs.filter("doc_id is not null").select("doc_id", "text", place)
    full = stored(texts.mapInArrow(giving_back(_full_sets(width, bits)), "doc_id long, shingles array<long>"), "sets", folder)
    both = pairs.join(full.toDF("a", "set_a"), "a").join(full.toDF("b", "set_b"), "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - shared
    # In hundredths, so that a similarity of exactly the threshold counts.
    listed = both.filter(100 * shared >= round(100 * threshold) * union).select("a", "b")
    return listed.union(stored(_links_of_crowds(crowds, full, threshold), "crowds", folder))


def near_duplicates(
    docs: DataFrame, width: int = 5, threshold: float = 0.8, trees: int = TREES
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for each row of
    ``docs`` (``doc_id``, ``text``; other columns are not looked at).

    ``component_id`` is the smallest ``doc_id`` that links lead to, and the row
    that bears it is kept. A text that is null, empty or without words is
    linked with nothing. Rows that repeat a ``doc_id`` are taken for the same
    document: each is judged by its own text. A row without ``doc_id`` takes no
    part; it is kept and has no component.
    """
    summaries = stored(
        docs.select("doc_id", "text").mapInArrow(
            giving_back(_summaries(width)), "doc_id long, n_shingles long, print_a long, print_b long, sketch binary"
        ),
        "summaries",
    )
    prints = ["n_shingles", "print_a", "print_b"]
    full = summaries.filter("n_shingles > 0 and doc_id is not null")
    classes = stored(full.groupBy(prints).agg(F.min("doc_id").alias("class_id")), "classes")
    first = full.join(
        classes.withColumnsRenamed({"class_id": "doc_id"}), ["doc_id", *prints], "left_semi"
    ).dropDuplicates(["doc_id", *prints])
    with scratch(docs.sparkSession, "trees") as folder:
        # Components read tables of their own: those of the trees can go.
        links = similar_pairs(docs, first, width, threshold, trees, folder)
        roots = connected_components(links).toDF("class_id", "root")
    member = classes.join(roots, "class_id", "left").select(
        *prints, F.coalesce("root", "class_id").alias("found")
    )
    joined = summaries.join(member, prints, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("found", "doc_id"))
    return joined.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
