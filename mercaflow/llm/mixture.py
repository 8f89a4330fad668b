"""Mixing sources to target weights.

Every source is one stream of words, its documents one after the other, packed
into blocks of ``block_words``. The mix is a row of slots, each of which takes
one block of one source; a run of slots is an output shard. How many slots of a
shard go to each source is a multinomial draw, conditioned on the totals that
the targets ask for (plain multinomials would miss the targets of small sources
by several percent): the totals are split over the shards by halves, each half
a multivariate hypergeometric draw from its own seed, so that every shard finds
its counts alone. A source's slots go through its blocks in the order of a
pseudorandom permutation of their indexes, a new one for each pass, computed
from the index and not stored. Slots and blocks are joined by index.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mercaflow.llm.memory import giving_back
from mercaflow.llm.storage import stored
from mercaflow.llm.words import U64, mix

BLOCK_WORDS = 64
SHARD_SLOTS = 4096
# The weights of the sources, repeating; words a source's target
# may hold for each word of the source.
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
# Documents whose places in their stream one task works out.
BUCKET_DOCS = 2048
# Bound of the per-source table that tasks hold.
MOST_SOURCES = 100_000

PART_SCHEMA = "source_no long, epoch long, position long, shard long, slot long"


def count_words(text: Column) -> Column:
    count = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(count, F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source``, ``source_no``, ``source_size``, ``weight`` and ``target`` from
    documents (``source``, ``size``).

    Targets share the total by weight; none exceeds ``MOST_REPEATS`` times its
    source, and the excess is shared again by weight until it has gone. A
    table has one row per source, of which there may be ``MOST_SOURCES``; it
    is refused beyond. Rows without words make a source of size 0.
    """
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = sums.limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError("more sources than a mix may have")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    size = np.array([r["source_size"] for r in rows], dtype=np.float64)
    weight = np.array([WEIGHTS[i % len(WEIGHTS)] for i in range(len(rows))], dtype=np.float64)
    target, free = np.zeros(len(rows)), size > 0
    while free.any():
        rest = size.sum() - target[~free].sum()
        shares = np.where(free, rest * weight / weight[free].sum(), target)
        over = free & (shares > MOST_REPEATS * size)
        target = np.where(over, MOST_REPEATS * size, shares)
        if not over.any():
            break
        free &= ~over
    return sizes.sparkSession.createDataFrame(
        [
            (r["source"], i, int(s), float(w), float(t))
            for i, (r, s, w, t) in enumerate(zip(rows, size, weight, target))
        ],
        "source string, source_no long, source_size long, weight double, target double",
    )


def _stream_places(docs: DataFrame) -> DataFrame:
    """``docs`` (``source_no``, ``doc_id``, ``size``, ``row``) with ``begin``,
    the place of the first word in the source's stream. The stream has its
    documents in buckets of a hash, so that a hot source is spread."""
    total = docs.agg(F.count(F.lit(1))).first()[0]
    buckets = max(1, math.ceil(total / BUCKET_DOCS))
    spread = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "row"), F.lit(buckets)))
    inner = Window.partitionBy("source_no", "bucket").orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("size").over(inner), F.lit(0))
    sums = spread.groupBy("source_no", "bucket").agg(F.sum("size").alias("in_bucket"))
    outer = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "bucket", F.coalesce(F.sum("in_bucket").over(outer), F.lit(0)).alias("before_bucket"))
    placed = spread.withColumn("before", before).join(sums, ["source_no", "bucket"])
    return placed.withColumn("begin", F.col("before") + F.col("before_bucket")).drop("before", "before_bucket", "bucket")


def permuted(index: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of ``0 .. size - 1`` at ``index``, for each
    row's own size and seed: four Feistel rounds on the next even number of
    bits, walked until the value falls below the size."""
    half = np.array([max(1, (int(s - 1).bit_length() + 1) // 2) for s in np.unique(size)], dtype=U64)
    half = half[np.searchsorted(np.unique(size), size)]
    mask = (U64(1) << half) - U64(1)
    value, todo = index.astype(U64), np.arange(len(index))
    while len(todo):
        left, right = value[todo] >> half[todo], value[todo] & mask[todo]
        for turn in range(4):
            left, right = right, left ^ (mix(right ^ seed[todo] ^ (U64(turn) << U64(56))) & mask[todo])
        value[todo] = (left << half[todo]) | right
        todo = todo[value[todo] >= size[todo].astype(U64)]
    return value.astype(np.int64)


def _hypergeometric(rng: np.random.Generator, counts: np.ndarray, drawn: int) -> np.ndarray:
    """Draws from ``counts`` without putting back. Beyond 10**9 in all, which
    is as far as numpy goes, each count is a rounded normal draw with the mean
    and variance of the hypergeometric one."""
    total = int(counts.sum())
    if total < 10**9:
        return rng.multivariate_hypergeometric(counts, drawn, method="marginals")
    out = np.zeros_like(counts)
    for i, count in enumerate(map(int, counts)):
        share = count / total if total else 0.0
        spread = math.sqrt(max(0.0, drawn * share * (1 - share) * (total - drawn) / max(1, total - 1)))
        value = round(drawn * share + spread * rng.standard_normal())
        out[i] = min(max(value, drawn - (total - count), 0), count, drawn)
        total, drawn = total - count, drawn - int(out[i])
    return out


def _shard_counts(totals: np.ndarray, shard: int, shards: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of each source in one shard, and in all shards before it."""
    low, high, before, here = 0, shards, np.zeros_like(totals), totals
    slots = int(totals.sum())
    while high - low > 1:
        middle = (low + high) // 2
        first = min(slots, middle * SHARD_SLOTS) - min(slots, low * SHARD_SLOTS)
        lower = _hypergeometric(np.random.default_rng([seed, low, high]), here, first)
        if shard < middle:
            here, high = lower, middle
        else:
            before, here, low = before + lower, here - lower, middle
    return here, before


def _filling(totals: np.ndarray, blocks: np.ndarray, shards: int, seed: int):
    """Rows of slots for each shard number."""

    def fill(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for shard in frame["id"]:
                here, before = _shard_counts(totals, shard, shards, seed)
                source = np.repeat(np.arange(len(totals)), here)
                ordinal = np.arange(len(source)) - np.repeat(np.cumsum(here) - here - before, here)
                order = np.random.default_rng([seed, shard, shards, 1]).permutation(len(source))
                yield pd.DataFrame(
                    {
                        "source_no": source,
                        "epoch": ordinal // np.maximum(1, blocks[source]),
                        "position": ordinal % np.maximum(1, blocks[source]),
                        "shard": shard,
                        "slot": order,
                    }
                )

    return fill


def _drawing(sizes: np.ndarray, targets: np.ndarray, blocks: np.ndarray, block_words: int, seed: int):
    """The block of each slot, and how many words it gives. A source's last
    slot gives what its target still lacks."""

    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if not len(frame):
                continue
            source, epoch, position = (frame[c].to_numpy() for c in ("source_no", "epoch", "position"))
            own = _pass_seed(source, epoch, seed)
            count = blocks[source]
            block = permuted(position, count, own)
            # The stream's last block is short: what came before it in this pass is known by its position.
            short = block_words * count - sizes[source]
            short_at = _place_of(count - 1, count, own)
            before = position * block_words - np.where(position > short_at, short, 0)
            whole = block_words - np.where(block == count - 1, short, 0)
            lacks = targets[source] - epoch * sizes[source] - before
            yield frame.assign(block=block, n_words=np.clip(lacks, 0, whole))

    return draw


def _pass_seed(source: np.ndarray, epoch: np.ndarray, seed: int) -> np.ndarray:
    own = mix(source.astype(U64) + U64(seed << 32))
    return mix(own ^ epoch.astype(U64))


def _place_of(value: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """The index that ``permuted`` takes to ``value``."""
    half = np.array([max(1, (int(s - 1).bit_length() + 1) // 2) for s in np.unique(size)], dtype=U64)
    half = half[np.searchsorted(np.unique(size), size)]
    mask = (U64(1) << half) - U64(1)
    found, todo = value.astype(U64), np.arange(len(value))
    while len(todo):
        left, right = found[todo] >> half[todo], found[todo] & mask[todo]
        for turn in reversed(range(4)):
            left, right = right ^ (mix(left ^ seed[todo] ^ (U64(turn) << U64(56))) & mask[todo]), left
        found[todo] = (left << half[todo]) | right
        todo = todo[found[todo] >= size[todo].astype(U64)]
    return found.astype(np.int64)


def mix_sources(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """The mix and the documents in it.

    The mix has a row for each piece of a document in each slot: ``shard``,
    ``slot``, ``source``, ``epoch``, ``block``, ``place`` (its first word within
    the block), ``doc_id``, ``row``, ``n_words`` and ``text``, the piece's words
    joined by spaces. The second table has a row for each row of ``docs``
    (``doc_id``, ``text``, ``source``): ``doc_id``, ``row`` (which tells rows of
    one id apart), ``size``, ``source``, ``source_size`` and ``target``.

    A source gives its target in whole words; no document is taken more than
    ``MOST_REPEATS`` times. The same table gives the same mix. A null source
    is a source; null and empty texts have size 0 and are never drawn.
    Repeated rows are documents of their own. Other columns are not looked at.
    """
    spark = docs.sparkSession
    columns = docs.select("doc_id", "source", "text", count_words(F.col("text")).alias("size"))
    # Rows of one id are told apart by their content; equal rows stand in any order.
    same = Window.partitionBy("doc_id").orderBy("source", "fingerprint")
    sizes = columns.select("doc_id", "source", "size", F.xxhash64("text").alias("fingerprint"))
    sizes = stored(sizes.withColumn("row", F.row_number().over(same).cast("long")).drop("fingerprint"), "sizes")
    targets = source_targets(sizes)
    per_source = targets.orderBy("source_no").collect()
    joined = sizes.join(F.broadcast(targets), sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    placed = stored(_stream_places(joined.select("doc_id", "row", "size", "source", "source_no", "source_size", "target")), "placed")

    size = np.array([r["source_size"] for r in per_source], dtype=np.int64)
    target = np.array([round(r["target"]) for r in per_source], dtype=np.int64)
    blocks = -(-size // block_words)
    totals = _slots(size, target, blocks, block_words, seed)
    shards = max(1, math.ceil(int(totals.sum()) / SHARD_SLOTS)) if len(totals) else 0
    slots = spark.range(shards).mapInPandas(giving_back(_filling(totals, blocks, shards, seed)), PART_SCHEMA)
    drawn = slots.mapInPandas(
        giving_back(_drawing(size, target, blocks, block_words, seed)), f"{PART_SCHEMA}, block long, n_words long"
    ).filter("n_words > 0").withColumnRenamed("n_words", "from_block")

    first, last = F.floor(F.col("begin") / block_words), F.floor((F.col("begin") + F.col("size") - 1) / block_words)
    pieces = placed.filter("size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("begin"), F.col("block") * block_words)
    end = F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select(
        "source_no", "block", "doc_id", "row", "source", (start - F.col("begin")).alias("first_word"),
        (start - F.col("block") * block_words).alias("place"), (end - start).alias("length"),
    )
    # Both sides grow with the input: their size is not known beforehand, and neither may be broadcast.
    taken = drawn.join(pieces.hint("merge"), ["source_no", "block"]).withColumn(
        "n_words", F.least("length", F.col("from_block") - F.col("place"))
    ).filter("n_words > 0").select(
        "shard", "slot", "source", "epoch", "block", "place", "doc_id", "row", "first_word", "n_words"
    )
    return taken, placed.select("doc_id", "row", "size", "source", "source_size", "target")


def _slots(size, target, blocks, block_words: int, seed: int) -> np.ndarray:
    """Slots that give each source its target."""
    totals = np.zeros(len(size), dtype=np.int64)
    for i in np.flatnonzero(size):
        passes, rest = divmod(int(target[i]), int(size[i]))
        totals[i] = passes * blocks[i]
        if rest:
            own = _pass_seed(np.array([i]), np.array([passes]), seed)
            short = block_words * blocks[i] - size[i]
            at = _place_of(blocks[i : i + 1] - 1, blocks[i : i + 1], own)[0]
            needed = -(-rest // block_words)
            totals[i] += needed if needed <= at else -(-(rest + short) // block_words)
    return totals


PIECE = "shard long, slot long, epoch long, block long, place long, first_word long, n_words long"
TEXT_SCHEMA = "doc_id long, source string, shard long, slot long, epoch long, block long, place long, n_words long, text string"


def _cut_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "text", "pieces")))
        for doc_id, source, text, pieces in columns:
            words = text.encode().split()
            rows = [
                {"doc_id": doc_id, "source": source, **p, "text": b" ".join(words[p["first_word"] : p["first_word"] + p["n_words"]]).decode()}
                for p in pieces
            ]
            frame = pa.Table.from_pylist(rows, schema=_TEXT).combine_chunks()
            yield from frame.to_batches()


_TEXT = pa.schema(
    [(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in TEXT_SCHEMA.split(", ")]
)


def with_texts(taken: DataFrame, docs: DataFrame) -> DataFrame:
    """The pieces of a mix with their ``text``: ``doc_id``, ``source``, ``shard``,
    ``slot``, ``epoch``, ``block``, ``place``, ``n_words`` and ``text``. Rows of
    ``docs`` that share a ``doc_id`` are told apart as ``mix_sources`` does."""
    same = Window.partitionBy("doc_id").orderBy("source", F.xxhash64("text"))
    texts = docs.select("doc_id", "source", "text").withColumn("row", F.row_number().over(same).cast("long"))
    piece = F.struct(*(c.split()[0] for c in PIECE.split(", ")))
    pieces = taken.groupBy("doc_id", "row").agg(F.collect_list(piece).alias("pieces")).toDF("id", "no", "pieces")
    key = texts["doc_id"].eqNullSafe(pieces["id"]) & (texts["row"] == pieces["no"])
    joined = texts.join(pieces, key).select("doc_id", "source", "text", "pieces")
    return joined.mapInArrow(giving_back(_cut_pieces), TEXT_SCHEMA)
