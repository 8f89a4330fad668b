"""Exact duplicates by a 128-bit content hash, in DataFrame functions.

Rows are grouped by the hash of their normalised text and, inside a hash, by the
bytes of that text, so a collision never joins two texts. Copies meet on the map
side of that grouping: a text with a third of all rows reaches the shuffle as one
row a task, and no group is ever gathered. Texts travel once; what goes back to
the rows is a table of hashes without texts.

Groups with more than one in ``HOT_SHARE`` of the rows that have copies are fewer
than ``HOT_SHARE``. They are broadcast and their rows stay spread by ``doc_id``;
all other groups are small and meet their rows in a shuffle.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from mercaflow.llm.storage import stored

#: Groups of more than one row in so many are broadcast: always fewer than this.
HOT_SHARE = 1000
COLUMNS = ("keep_id", "group_size", "kept", "text_sha256")

Function = Callable[[Column], Column]


def content_hash(text: Column) -> Column:
    """128 bits of a text's content."""
    return F.unhex(F.md5(text))


def unchanged(text: Column) -> Column:
    return text


def _groups(texts: DataFrame, pick: Function) -> DataFrame:
    """``__hash`` of all texts of several rows, with the ``n_texts`` that share it."""
    by_bytes = texts.groupBy("__hash", "__text").agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    return by_bytes.groupBy("__hash").agg(
        F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("group_size"), F.any_value("keep_id").alias("keep_id")
    ).filter("group_size > 1")


def _marked(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with the ``keep_id`` and ``group_size`` of their hash, if any."""
    most = groups.agg(F.sum("group_size")).first()[0] or 0
    hot = groups.filter(F.col("group_size") * HOT_SHARE > most)
    hot = hot.select("__hash", F.struct("keep_id", "group_size").alias("__hot"))
    rest = groups.filter(F.col("group_size") * HOT_SHARE <= most)
    rest = rest.select(F.col("__hash").alias("__key"), F.struct("keep_id", "group_size").alias("__cold"))
    spread = F.unhex(F.md5(F.concat_ws(":", F.hex("__hash"), F.col("doc_id").cast("string"))))
    key = F.when(F.col("__hot").isNull(), F.col("__hash")).otherwise(spread)
    met = rows.join(F.broadcast(hot), "__hash", "left").withColumn("__key", key).join(rest, "__key", "left")
    group = F.coalesce("__hot", "__cold")
    return met.withColumns({"keep_id": group["keep_id"], "group_size": group["group_size"]}).drop(
        "__hot", "__cold", "__key"
    )


def exact_duplicates(
    docs: DataFrame, keep: str = "smallest", normalise: Function = unchanged, hashed: Function = content_hash
) -> DataFrame:
    """All rows of ``docs`` with their columns and ``keep_id`` (the ``doc_id`` of
    the row that stays of those with an equal text: the smallest or the largest),
    ``group_size``, ``kept`` and ``text_sha256`` (of the normalised text).

    A null text counts as empty; empty texts are copies of one another. A null
    ``doc_id`` stays only where no equal text has an id. Rows equal in id and text
    cannot be told apart and share one result; ``without_copies`` leaves one of
    them. Texts of any length are compared whole. Columns of ``docs`` that clash
    with the four are replaced. An empty table gives no rows.
    """
    pick = {"smallest": F.min, "largest": F.max}[keep]
    text = normalise(F.coalesce(F.col("text"), F.lit("")))
    texts = docs.select("doc_id", text.alias("__text")).withColumn("__hash", hashed(F.col("__text")))
    groups = stored(_groups(texts, pick), "copies")
    rows = docs.drop(*COLUMNS).withColumn("__text", text)
    rows = rows.withColumns({"__hash": hashed(F.col("__text")), "text_sha256": F.sha2("__text", 256)})
    collided = groups.filter("n_texts > 1").select("__hash")
    if collided.isEmpty():
        found = _marked(rows, groups)
    else:
        # Different texts under one hash: these are told apart by their bytes.
        apart = _marked(rows.join(collided, "__hash", "left_anti"), groups.filter("n_texts = 1"))
        exact = texts.join(collided, "__hash", "left_semi").groupBy("__text").agg(
            pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
        found = rows.join(collided, "__hash", "left_semi").join(exact, "__text").unionByName(apart)
    # A row without a group is alone with its text.
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    found = found.withColumns({"keep_id": keep_id, "group_size": F.coalesce("group_size", F.lit(1).cast("long"))})
    found = found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))
    return found.select(*(c for c in docs.columns if c not in COLUMNS), *COLUMNS)


def without_copies(
    docs: DataFrame, keep: str = "smallest", normalise: Function = unchanged, hashed: Function = content_hash
) -> DataFrame:
    """``docs`` with one row of each group of equal texts, and its own columns."""
    marked = exact_duplicates(docs.withColumn("__row", F.struct(*docs.columns)), keep, normalise, hashed)
    alone, copies = marked.filter("group_size = 1"), marked.filter("group_size > 1 and kept")
    one = alone.unionByName(copies.dropDuplicates(["doc_id", "text_sha256"]))
    return one.select("__row.*")
