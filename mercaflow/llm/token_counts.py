"""Token counts of flat token files without an index.

A flat file is token after token, unsigned little-endian, with an
end-of-document identifier behind each document and nothing else. Files are read
by Spark as they are; a task searches each block of a file for the identifier,
vectorised, and hands on the places found. How many documents, and which last
place, lie before a block follows from a prefix scan over the blocks of its
file: that stitches documents which cross blocks.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mercaflow.llm.storage import shared_path, stored
from mercaflow.llm.words import PLAIN, U64, words_of

BLOCK_BYTES = 1 << 20
# Documents of one file.
FILE_DOCS = 4096
# Tokens are 16 bits wide, and 0 ends a document.
TOKEN = np.dtype("<u2")
SEPARATOR = 0
SEPARATOR_BYTES = SEPARATOR.to_bytes(TOKEN.itemsize, "little").decode("latin-1")


def _encoding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as the bytes of its tokens: its words, hashed to 1 .. 65535."""
    for batch in batches:
        for words in words_of(batch.column("text"), PLAIN):
            tokens = (words.hashes % U64(65535) + U64(1)).astype(TOKEN)
            part = batch.slice(words.first, words.last - words.first)
            texts = [tokens[a:b].tobytes() for a, b in zip(words.bounds, words.bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column("file"), part.column("place"), pa.array(texts, type=pa.binary())], ["file", "place", "tokens"]
            )


def write_flat_files(docs: DataFrame, path: str) -> DataFrame:
    """Writes the texts of ``docs`` (``doc_id``, ``text``) as flat token files,
    one below each folder ``file=...``, and returns which document stands where:
    ``file``, ``place`` (its number within the file) and ``doc_id``.

    Null and empty texts are documents without tokens. Rows that repeat a
    ``doc_id`` are documents of their own, in the order of their texts' hashes.
    """
    total = docs.count()
    files = max(1, -(-total // FILE_DOCS))
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("print"))
    named = named.withColumn("file", F.pmod(F.xxhash64("doc_id", "print"), F.lit(files)))
    order = Window.partitionBy("file").orderBy("doc_id", "print")
    places = stored(
        named.select("file", "doc_id", "print").withColumn("place", (F.row_number().over(order) - 1).cast("long")),
        "places",
    )
    # Tokens are made where the texts are read; only tokens travel.
    placed = named.select("file", F.struct("doc_id", "print").alias("place"), "text")
    encoded = placed.mapInArrow(_encoding, "file long, place struct<doc_id: long, print: long>, tokens binary")
    dealt = encoded.repartition(files, "file").sortWithinPartitions("file", "place")
    flat = dealt.select("file", F.col("tokens").cast("string").alias("value"))
    flat.write.option("lineSep", SEPARATOR_BYTES).partitionBy("file").text(path)
    return places.select("file", "place", "doc_id")


def _scanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ends of documents in each block of each file, as places in the file."""
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
            tokens = np.frombuffer(content.as_buffer(), dtype=TOKEN)
            step = BLOCK_BYTES // TOKEN.itemsize
            for block, first in enumerate(range(0, len(tokens), step)):
                ends = np.flatnonzero(tokens[first : first + step] == SEPARATOR) + first
                if len(ends):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path]), pa.array([block]), pa.array([ends], type=pa.list_(pa.int64()))],
                        ["path", "block", "ends"],
                    )


def separator_scan(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``place`` (from 0) and ``n_tokens`` of each document in the
    flat token files below ``path``. Tokens behind the last end of a file
    belong to no document; an empty file has none. A file is at most 2 GB, as
    far as Spark reads binary files, and is held by the task that scans it."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    found = files.select("path", "content").mapInArrow(_scanning, "path string, block long, ends array<long>")
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = stored(found, "ends").withColumns(
        {
            "documents": F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)),
            "last": F.coalesce(F.max(F.element_at("ends", -1)).over(before), F.lit(-1)),
        }
    )
    each = stitched.select("path", "documents", "last", "ends", F.posexplode("ends").alias("at", "end"))
    begin: Column = F.when(F.col("at") == 0, F.col("last")).otherwise(F.get("ends", F.col("at") - 1))
    return each.select("path", (F.col("documents") + F.col("at")).alias("place"), (F.col("end") - begin - 1).alias("n_tokens"))


def token_counts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``n_tokens`` of each row of ``docs`` (``doc_id``, ``text``),
    found by writing flat files and scanning them. Other columns are not looked
    at; an empty table gives no rows."""
    spark = docs.sparkSession
    path = shared_path(spark, "tokens")
    places = write_flat_files(docs, path)
    counts = separator_scan(spark, path)
    file = F.regexp_extract("path", r"/file=(\d+)/", 1).cast("long").alias("file")
    return counts.select(file, "place", "n_tokens").join(places, ["file", "place"]).select("doc_id", "n_tokens")
