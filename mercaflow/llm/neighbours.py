"""Approximate nearest neighbours by NN-descent and greedy graph search.

Equal vectors are one node, so that no group of copies of any size can fill a
node's neighbour list. The graph starts from cells of random hyperplanes, whose
thresholds come from ``SAMPLE`` vectors (all vectors are placed), and improves
in rounds until few entries change: a node's neighbours, forward and reverse, are joined to the node, and
compared among themselves, but for two that were neighbours of it before: those
were compared then. A hub with many reverse neighbours is met in several
groups; none is left out. Queries start at their own node and expand the
nearest unexpanded nodes of a beam until there are none.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from mercaflow.llm.storage import partitions, stored
from mercaflow.llm.words import U64, mix

DEGREE = 40
BEAM = 200
TREES = 8
# Rounds end when no more than this part of the graph's entries is new.
SETTLED = 0.005
CELL = 256
GROUP = 48
SAMPLE = 10_000
# Nodes whose neighbours one task holds at once, with their vectors.
BUCKET = 2048
ENTRIES = "array<struct<d: float, id: long>>"
GRAPH = f"node long, entries {ENTRIES}, fresh array<boolean>"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``embedding`` (array of float or double) of the rows that
    can be compared: id and vector are there, all components are finite, not
    all are zero, and the length is the most frequent one (of several, the
    largest). A ``vec_id`` that repeats counts once, with its least vector."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = vectors.select("vec_id", "embedding").filter(
        F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0)
    )
    length = good.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    good = good.filter(F.size("embedding") == (length["n"] if length else 0))
    return good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def _classes(vectors: DataFrame, k: int) -> DataFrame:
    """A row for each different vector: ``node``, its smallest id, and the
    ``k + 1`` smallest ids that have it."""
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = vectors.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    members = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
    return members.select(F.col("members")[0].alias("node"), "members", "embedding")


def _whole(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = _whole(column).flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float32, copy=False).reshape(len(column), -1)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes, which pass between Spark and Python in one piece each."""
    for batch in batches:
        if len(batch):
            rows = pa.array([row.tobytes() for row in _matrix(batch.column("embedding"))], type=pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), rows], ["node", "vector"])


def _packed(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors of a column of ``_pack``."""
    column = _whole(column)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[ends[0] : ends[-1]].view(np.float32).reshape(len(column), -1)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of pairs, the same for a pair wherever it is met."""
    return np.square(a - b).sum(axis=1, dtype=np.float32)


def _all_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.square(a).sum(1)[:, None] + np.square(b).sum(1)[None, :] - 2 * (a @ b.T)


def _cells(planes: np.ndarray, thresholds: np.ndarray):
    """The cell of each vector in each tree."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                matrix = _packed(batch.column("vector"))
                for tree in range(len(planes)):
                    sides = (matrix @ planes[tree].T > thresholds[tree]).astype(np.int64)
                    cell = (sides << np.arange(sides.shape[1])).sum(axis=1)
                    columns = [*batch.columns, pa.array(np.full(len(batch), tree, dtype=np.int64)), pa.array(cell)]
                    yield pa.RecordBatch.from_arrays(columns, ["node", "vector", "tree", "cell"])

    return place


def _entries(owner: np.ndarray, other: np.ndarray, square: np.ndarray, former: np.ndarray | None = None) -> pa.Table:
    """The ``DEGREE`` nearest others of each owner, one row per owner; with
    ``former``, the entries it had before, also which entries are fresh."""
    order = np.lexsort((other, square, owner) if former is None else (~former, other, square, owner))
    owner, other, square = owner[order], other[order], square[order]
    first = np.ones(len(owner), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (other[1:] != other[:-1])
    rows = np.flatnonzero(first)
    starts = np.flatnonzero(np.concatenate([[True], owner[rows][1:] != owner[rows][:-1]])) if len(rows) else rows
    counts = np.diff(np.append(starts, len(rows)))
    rows = rows[np.arange(len(rows)) - np.repeat(starts, counts) < DEGREE]
    counts = np.minimum(counts, DEGREE)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
    pairs = [pa.array(square[rows].astype(np.float32)), pa.array(other[rows].astype(np.int64))]
    listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(pairs, ["d", "id"]))
    columns = {"node": pa.array(owner[rows][offsets.to_numpy()[:-1]].astype(np.int64)), "entries": listed}
    if former is not None:
        columns["fresh"] = pa.ListArray.from_arrays(offsets, pa.array(~former[order][rows]))
    return pa.table(columns)


def _nearest_in_cell(table: pa.Table) -> pa.Table:
    ids, matrix = table["node"].to_numpy(), _packed(table["vector"])
    squares = _all_squares(matrix, matrix)
    np.fill_diagonal(squares, np.inf)
    count = min(DEGREE, len(ids) - 1)
    if count < 1:
        nothing = np.zeros(0, dtype=np.int64)
        return _entries(nothing, nothing, nothing)
    near = np.argpartition(squares, count - 1, axis=1)[:, :count].ravel()
    own = np.repeat(np.arange(len(ids)), count)
    return _entries(ids[own], ids[near], _squares(matrix[own], matrix[near]))


def _merge(table: pa.Table) -> pa.Table:
    """All entries of the nodes in a bucket as one row per node."""
    lists = _whole(table["entries"])
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    owner, former = (np.repeat(table[c].to_numpy(), sizes) for c in ("node", "former"))
    return _entries(owner, flat.field("id").to_numpy(), flat.field("d").to_numpy(), former)


def _buckets(spark: SparkSession, count: int) -> int:
    return max(4 * partitions(spark), math.ceil(count / BUCKET))


def _merged(better: DataFrame, buckets: int, graph: DataFrame | None = None) -> DataFrame:
    """The graph of the nearest of all entries; those ``graph`` has not are fresh."""
    entries = better.select("node", "entries", F.lit(False).alias("former"))
    if graph is not None:
        entries = entries.union(graph.select("node", "entries", F.lit(True)))
    bucket = F.pmod(F.xxhash64("node"), F.lit(buckets)).alias("bucket")
    return entries.select("*", bucket).groupBy("bucket").applyInArrow(_merge, GRAPH)


def _first_graph(nodes: DataFrame, packed: DataFrame, seed: int, count: int) -> DataFrame:
    sample = nodes.orderBy(F.xxhash64("node", F.lit(seed))).select("embedding").limit(SAMPLE).toArrow()
    bits = max(0, math.ceil(math.log2(max(1, count) / CELL)))
    matrix = _matrix(sample["embedding"])
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((TREES, bits, matrix.shape[1])).astype(np.float32)
    thresholds = np.stack([np.median(matrix @ p.T, axis=0) for p in planes])
    placed = packed.mapInArrow(_cells(planes, thresholds), "node long, vector binary, tree long, cell long")
    placed = stored(placed, "cells")
    sizes = placed.groupBy("tree", "cell").agg(F.ceil(F.count(F.lit(1)) / (2 * CELL)).alias("parts"))
    part = F.pmod(F.xxhash64("node", "tree"), F.col("parts")).alias("part")
    parted = placed.join(sizes, ["tree", "cell"]).select("node", "vector", "tree", "cell", part)
    near = parted.groupBy("tree", "cell", "part").applyInArrow(_nearest_in_cell, f"node long, entries {ENTRIES}")
    return stored(_merged(near, _buckets(nodes.sparkSession, count)), "graph")


def _links(graph: DataFrame) -> DataFrame:
    """Edges of the graph in both directions."""
    forward = graph.select("node", F.explode("entries.id").alias("other"))
    return forward.union(forward.select("other", "node")).distinct()


def _group(table: pa.Table) -> pa.Table:
    """The distinct links of the nodes in a bucket, in groups of a node's links,
    each with whether it is fresh, which it is not if either end had it before.
    Groups without a fresh link are done with."""
    node, other, fresh = (table[c].to_numpy() for c in ("node", "other", "fresh"))
    order = np.lexsort((fresh, other, node))
    node, other, fresh = node[order], other[order], fresh[order]
    first = np.ones(len(node), dtype=bool)
    first[1:] = (node[1:] != node[:-1]) | (other[1:] != other[:-1])
    node, other, fresh = node[first], other[first], fresh[first]
    starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
    counts = np.diff(np.append(starts, len(node)))
    # The part of a link depends on its ends alone, as long as the node has as many.
    parts = np.repeat(-(-counts // GROUP), counts)
    mixed = mix(other.view(U64) ^ mix(node.view(U64)))
    part = (mixed % parts.astype(U64)).astype(np.int64)
    group = np.repeat(np.cumsum(-(-counts // GROUP)) + (counts // -GROUP), counts) + part
    open_ = np.bincount(group, weights=fresh)[group] > 0
    columns = {"node": node, "part": part, "other": other, "fresh": fresh}
    return pa.table({name: pa.array(values[open_]) for name, values in columns.items()})


def _grouped(graph: DataFrame, buckets: int) -> DataFrame:
    """The links of each node in groups of about ``GROUP``."""
    forward = graph.select("node", "fresh", F.posexplode("entries.id").alias("at", "other"))
    forward = forward.select("node", "other", F.col("fresh")[F.col("at")].alias("fresh"))
    both = forward.union(forward.select("other", "node", "fresh"))
    bucket = F.pmod(F.xxhash64("node"), F.lit(buckets)).alias("bucket")
    return both.select("*", bucket).groupBy("bucket").applyInArrow(
        _group, "node long, part long, other long, fresh boolean"
    )


def _local_join(table: pa.Table) -> pa.Table:
    """New neighbours among the members of each group of a bucket: all pairs of
    which one member is fresh."""
    node, part = table["node"].to_numpy(), table["part"].to_numpy()
    order = np.lexsort((part, node))
    node, part = node[order], part[order]
    ids, bound, fresh = (table[c].to_numpy()[order] for c in ("other", "bound", "fresh"))
    matrix = _packed(table["vector"])[order]
    starts = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (part[1:] != part[:-1])]))
    found = [(np.zeros(0, dtype=np.int64),) * 2]
    for a, b in zip(starts, np.append(starts[1:], len(ids))):
        new = np.flatnonzero(fresh[a:b]) + a
        if not len(new):
            continue
        squares = _all_squares(matrix[new], matrix[a:b])
        squares[np.arange(len(new)), new - a] = np.inf
        left, right = np.nonzero(squares < bound[new, None])
        found.append((new[left], right + a))
        left, right = np.nonzero(squares < bound[None, a:b])
        found.append((right + a, new[left]))
    left, right = (np.concatenate(x) for x in zip(*found))
    return _entries(ids[left], ids[right], _squares(matrix[left], matrix[right]))


def _descend(graph: DataFrame, packed: DataFrame, count: int) -> DataFrame:
    """One round: neighbours of neighbours take the places of farther ones."""
    buckets = _buckets(graph.sparkSession, count)
    bound = F.when(F.size("entries") < DEGREE, float("inf")).otherwise(F.element_at("entries.d", -1))
    known = stored(packed.join(graph.select("node", bound.cast("float").alias("bound")), "node"), "bounded")
    member = known.select(F.col("node").alias("other"), "vector", "bound")
    full = _grouped(graph, buckets).join(member, "other")
    bucket = F.pmod(F.xxhash64("node", "part"), F.lit(buckets))
    better = full.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(
        _local_join, f"node long, entries {ENTRIES}"
    )
    return stored(_merged(better, buckets, graph), "graph")


def build_graph(nodes: DataFrame, seed: int = 5) -> DataFrame:
    """``node`` and its ``entries``: squared distances and ids, nearest first."""
    count = nodes.count()
    packed = stored(nodes.select("node", "embedding").mapInArrow(_pack, "node long, vector binary"), "packed")
    graph = _first_graph(nodes, packed, seed, count)
    while True:
        graph = _descend(graph, packed, count)
        fresh = F.size(F.filter("fresh", lambda x: x))
        state = graph.agg(F.sum(fresh).alias("fresh"), F.sum(F.size("entries")).alias("all")).first()
        if (state["fresh"] or 0) <= SETTLED * (state["all"] or 0):
            return graph.select("node", "entries")


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Squared distances of queries and the nodes they met."""
    for batch in batches:
        if len(batch):
            squares = _squares(_packed(batch.column("query_vector")), _packed(batch.column("vector")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id"), batch.column("id"), pa.array(squares)], ["query_id", "id", "d"]
            )


def _search(queries: DataFrame, graph: DataFrame, nodes: DataFrame) -> DataFrame:
    """``query_id`` and ``id``, the nodes in each query's final beam."""
    links = stored(_links(graph), "links")
    own = queries.join(graph, "node").select("query_id", F.explode("entries").alias("e"))
    beam = stored(own.select("query_id", "e.id", "e.d", F.lit(True).alias("open")), "beam")
    best = Window.partitionBy("query_id").orderBy("d", "id")
    vectors = stored(nodes.select("node", "embedding").mapInArrow(_pack, "node long, vector binary"), "packed").toDF("id", "vector")
    own_vector = queries.select(F.col("query_id").alias("node"), "embedding").mapInArrow(_pack, "node long, vector binary")
    asked = queries.select("query_id", F.col("node").alias("own")).join(own_vector.toDF("query_id", "query_vector"), "query_id")
    asked = stored(asked, "asked")
    while not beam.filter("open").isEmpty():
        front = beam.filter("open").select("query_id", F.col("id").alias("node"))
        met = front.join(links, "node").select("query_id", F.col("other").alias("id")).distinct()
        met = met.join(beam, ["query_id", "id"], "left_anti").join(asked.select("query_id", "own"), "query_id").filter("id <> own")
        pairs = met.select("query_id", "id").join(vectors, "id").join(asked.select("query_id", "query_vector"), "query_id")
        fresh = pairs.mapInArrow(_measure, "query_id long, id long, d float").withColumn("open", F.lit(True))
        both = beam.withColumn("open", F.lit(False)).union(fresh)
        beam = stored(both.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= BEAM).drop("r"), "beam")
    return beam.select("query_id", "id")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (Euclidean distance in
    double precision): the ``k`` nearest rows found for each of ``queries``,
    rows of ``vectors`` (``vec_id``, ``embedding``), its own row left out.

    Rows that ``usable`` leaves out are neither asked nor found. Ties go to the
    smaller ``vec_id``. Other columns are not looked at. Empty tables give no
    rows.
    """
    vectors = stored(usable(vectors).select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), F.col("embedding").alias("exact")), "vectors")
    classes = stored(_classes(vectors.select("vec_id", F.col("exact").alias("embedding")), k), "classes")
    nodes = stored(classes.select("node", F.col("embedding").cast("array<float>").alias("embedding")), "nodes")
    ids = queries.select(F.col("vec_id").alias("query_id")).distinct()
    asked = vectors.join(ids, vectors["vec_id"] == ids["query_id"]).select("query_id", F.col("exact"))
    asked = asked.join(classes.select("node", F.col("embedding").alias("exact")), "exact")
    asked = stored(asked.select("query_id", "node", "exact", F.col("exact").cast("array<float>").alias("embedding")), "asked")
    if asked.isEmpty():
        return asked.select("query_id", F.lit(1).alias("rank"), F.col("node").alias("vec_id"), F.lit(0.0).alias("score"))
    found = _search(asked, build_graph(nodes), nodes)
    found = found.union(asked.select("query_id", F.col("node").alias("id")))
    pairs = found.join(asked.select("query_id", "exact"), "query_id").join(
        classes.select(F.col("node").alias("id"), "members", F.col("embedding").alias("other")), "id"
    )
    squares = F.zip_with("exact", "other", lambda x, y: (x.cast("double") - y) * (x.cast("double") - y))
    score = F.sqrt(F.aggregate(squares, F.lit(0.0), lambda s, x: s + x))
    rows = pairs.select("query_id", score.alias("score"), F.explode("members").alias("vec_id")).filter("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
