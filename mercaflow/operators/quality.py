"""Data-quality metrics and the split of unreadable records."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from mercaflow.functions.columns import named
from mercaflow.schemas import CORRUPT_COLUMN

# The column that tells the two kinds of records apart in one write, and its values.
ROUTE, READABLE, UNREADABLE = "_route", "readable", "unreadable"


def quality_metrics(df: DataFrame, required: Sequence[str] = ()) -> dict[str, Column]:
    """Record count and NULL count of each required column that exists.

    The expressions suit both ``agg`` and ``observe``; a job observes them on
    the frame it writes, so they cost no scan of their own.
    """
    metrics = {"records": F.count(F.lit(1))}
    for column in required:
        if column in df.columns:
            metrics[f"null_{column}"] = F.count_if(named(column).isNull())
    if CORRUPT_COLUMN in df.columns:
        metrics["corrupt"] = F.count_if(F.col(CORRUPT_COLUMN).isNotNull())
    return metrics


def quality_report(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    return df.agg(*[expr.alias(name) for name, expr in quality_metrics(df, required).items()])


def readable_records(df: DataFrame) -> DataFrame:
    if CORRUPT_COLUMN not in df.columns:
        return df
    return df.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)


def corrupt_records(df: DataFrame) -> DataFrame:
    """Unreadable records: raw text, what could be parsed, and provenance."""
    return df.filter(F.col(CORRUPT_COLUMN).isNotNull())


def with_route(df: DataFrame) -> DataFrame:
    """``df`` with the kind of each record, for a write that parts them."""
    if CORRUPT_COLUMN not in df.columns:
        return df.withColumn(ROUTE, F.lit(READABLE))
    kind = F.when(F.col(CORRUPT_COLUMN).isNull(), READABLE).otherwise(UNREADABLE)
    return df.withColumn(ROUTE, kind)
