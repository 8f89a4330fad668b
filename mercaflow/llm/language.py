"""Language identification: multinomial naive Bayes over hashed character
n-grams.

Counts are gathered over all training texts: each task adds up its own and sends
blocks of them, by cell where few are set, and Spark adds the blocks of all
tasks. The model, a matrix of
log-probabilities of ``BUCKETS`` x languages, is broadcast; its size depends on
the number of languages only and is checked. Texts are scored in batches.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from mercaflow.llm.memory import giving_back

UNDETERMINED = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
# Counts travel in blocks of this many buckets.
BLOCK = 1 << 13
# Characters that are worked on at a time, whatever the length of a text.
PIECE = 1 << 19
# Bytes of text that are taken out of an Arrow batch at a time.
SLICE_BYTES = 4 << 20
SMOOTHING = 0.5
# Bound of the broadcast: 1,000 languages.
MODEL_BYTES = BUCKETS * 8 * 1000
_FACTOR, _STEP = np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B)


def _pieces(texts: list[str | None]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Joined texts of about ``PIECE`` characters, with the row and the first
    character of each part; long texts come in several parts."""
    parts, rows, size = [], [], 0
    for row, text in enumerate(texts):
        text = text or ""
        for begin in range(0, len(text), PIECE):
            part = text[max(0, begin - max(ORDERS) + 1) : begin + PIECE].lower()
            parts.append(part)
            rows.append(row)
            size += len(part) + 1
            if size >= PIECE:
                yield _joined(parts, rows)
                parts, rows, size = [], [], 0
    if parts:
        yield _joined(parts, rows)


def _joined(parts: list[str], rows: list[int]) -> tuple[str, np.ndarray, np.ndarray]:
    lengths = np.array([len(p) + 1 for p in parts])
    return "\n".join(parts) + "\n", np.array(rows), np.cumsum(lengths) - lengths


def _features(text: str) -> Iterator[np.ndarray]:
    """For each order, the buckets of the n-grams that begin at each character."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    value = np.zeros(len(codes), dtype=np.uint32)
    for order in range(1, max(ORDERS) + 1):
        value = value[: len(codes) - order + 1] * _FACTOR + codes[order - 1 :]
        if order in ORDERS:
            mixed = (value ^ (value >> np.uint32(15))) * _STEP + np.uint32(order)
            yield ((mixed ^ (mixed >> np.uint32(13))) * _FACTOR >> np.uint32(16)).astype(np.int64) & (BUCKETS - 1)


def _counting(languages: dict[str, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        documents = np.zeros(len(languages), dtype=np.int64)
        for batch in batches:
            own = np.array([languages[x] for x in batch.column("lang").to_pylist()], dtype=np.int64)
            documents += np.bincount(own, minlength=len(languages))
            for first, texts in _slices(batch.column("text")):
                for text, rows, starts in _pieces(texts):
                    language = np.repeat(own[first + rows], np.diff(np.append(starts, len(text))))
                    for buckets in _features(text):
                        cells, n = np.unique(language[: len(buckets)] * BUCKETS + buckets, return_counts=True)
                        counts.reshape(-1)[cells] += n
        for code in np.flatnonzero(documents):
            for block in range(0, BUCKETS, BLOCK):
                set_cells, payload = _packed(counts[code, block : block + BLOCK])
                yield pa.RecordBatch.from_pydict(
                    {
                        "language": [int(code)],
                        "block": [block],
                        "documents": [int(documents[code]) if block == 0 else 0],
                        "cells": [set_cells],
                        "counts": [payload],
                    }
                )

    return count


def _slices(column: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """First row and texts of parts of a column of about ``SLICE_BYTES`` each."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
    borders = [*np.flatnonzero(np.diff(part, prepend=-1)), len(column)]
    for first, last in zip(borders, borders[1:]):
        yield int(first), column.slice(first, last - first).to_pylist()


def _packed(counts: np.ndarray) -> tuple[bytes | None, bytes]:
    """A block's counts: those that are set with their cells, or all of them."""
    some = np.flatnonzero(counts)
    if 10 * len(some) < 8 * len(counts):
        return some.astype("<u2").tobytes(), counts[some].astype("<i8").tobytes()
    return None, counts.astype("<i8").tobytes()


def _adding(frame: pa.Table) -> pa.Table:
    counts = np.zeros(BLOCK, dtype=np.int64)
    for cells, values in zip(frame["cells"], frame["counts"]):
        values = np.frombuffer(values.as_buffer(), dtype="<i8")
        if cells.is_valid:
            counts[np.frombuffer(cells.as_buffer(), dtype="<u2")] += values
        else:
            counts += values
    first = frame.slice(0, 1)
    return pa.Table.from_pydict(
        {
            "language": first["language"].to_pylist(),
            "block": first["block"].to_pylist(),
            "documents": [pc.sum(frame["documents"]).as_py()],
            "cells": pa.array([None], pa.binary()),
            "counts": [counts.astype("<i8").tobytes()],
        }
    )


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_probability: np.ndarray  # bucket x language


COUNT_SCHEMA = "language long, block long, documents long, cells binary, counts binary"


def fit(labelled: DataFrame) -> Model | None:
    """The model of all rows with a ``lang``; None where there is no such row.
    Rows without text only count for the share of their language."""
    labelled = labelled.filter("lang is not null").select("text", "lang")
    names = sorted(r["lang"] for r in labelled.select("lang").distinct().limit(MODEL_BYTES // BUCKETS // 8 + 1).collect())
    if not names:
        return None
    if len(names) * BUCKETS * 8 > MODEL_BYTES:
        raise ValueError("more languages than the broadcast model may hold")
    codes = {name: i for i, name in enumerate(names)}
    counted = labelled.mapInArrow(giving_back(_counting(codes)), COUNT_SCHEMA)
    summed = counted.groupBy("language", "block").applyInArrow(_adding, COUNT_SCHEMA)
    counts, documents = np.zeros((len(names), BUCKETS)), np.zeros(len(names))
    for row in summed.toLocalIterator():
        counts[row["language"], row["block"] : row["block"] + BLOCK] = np.frombuffer(row["counts"], dtype="<i8")
        documents[row["language"]] += row["documents"]
    share = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    prior = (documents + 1) / (documents.sum() + len(names))
    return Model(names, np.log(prior), np.ascontiguousarray(np.log(share).T))


def _scores(model: Model, column: pa.Array) -> np.ndarray:
    scores = np.tile(model.log_prior, (len(column), 1))
    for first, texts in _slices(column):
        for text, rows, starts in _pieces(texts):
            for buckets in _features(text):
                inner = np.minimum(starts, max(0, len(buckets) - 1))
                for language in range(len(model.languages)):
                    values = model.log_probability[:, language][buckets]
                    if len(values):
                        part = np.add.reduceat(values, inner)
                        np.add.at(scores[:, language], first + rows, part)
    return scores


def _predicting(broadcast):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for batch in batches:
            scores = _scores(model, batch.column("text"))
            best = scores.argmax(axis=1)
            certainty = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            known = batch.column("has_letter").to_numpy(zero_copy_only=False)
            names = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, type=pa.string()), pa.array(np.where(known, certainty, 0.0))],
                ["doc_id", "lang_pred", "score"],
            )

    return predict


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score``, the probability of that language,
    for each row of ``docs`` (``doc_id``, ``text``; nothing else is looked at).

    A text that is null or has no letter is ``und`` with a score of 0, and so
    is every text where nothing was learned. Ties go to the first language in
    code-point order. Repeated rows get equal results.
    """
    rows = docs.select("doc_id", "text", has_letter(F.col("text")).alias("has_letter"))
    if model is None:
        return rows.select("doc_id", F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    broadcast = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(giving_back(_predicting(broadcast)), "doc_id long, lang_pred string, score double")


def in_known_language(docs: DataFrame, model: Model | None, least_score: float = 0.5) -> DataFrame:
    """The rows of ``docs``, unchanged, whose language is determined with a
    score of ``least_score`` or more; all columns pass."""
    kept = docs.filter(has_letter(F.col("text")))
    if model is None:
        return kept.filter(F.lit(False))
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(broadcast.value, batch.column("text"))
            certainty = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            yield batch.filter(pa.array(certainty >= least_score))

    return kept.mapInArrow(giving_back(keep), docs.schema)
