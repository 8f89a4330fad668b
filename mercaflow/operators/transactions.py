"""Transaction feeds: alias normalization, typing, union, table vocabularies."""
from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from mercaflow.functions.columns import coalesce_aliases, ensure_columns
from mercaflow.schemas import SILVER_NAMES, TRANSACTION_ALIASES, TRANSACTIONS


def standardize_transactions(df: DataFrame) -> DataFrame:
    """One feed in the canonical columns; a single narrow projection."""
    canonical = coalesce_aliases(df, TRANSACTION_ALIASES, TRANSACTIONS)
    return canonical.withColumn(
        "revenue", F.coalesce("revenue", F.col("quantity") * F.col("unit_price"))
    )


def union_feeds(feeds: Iterable[DataFrame | None]) -> DataFrame | None:
    """Standardize each feed, then union by name; absent feeds are skipped."""
    present = [standardize_transactions(feed) for feed in feeds if feed is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def to_silver_names(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(SILVER_NAMES)


def to_gold_names(df: DataFrame) -> DataFrame:
    """Rename a stored silver table to the engine's names and add ``txn_date``.

    A name that is already present is left alone, so either vocabulary works.
    """
    renames = {
        stored: name
        for name, stored in SILVER_NAMES.items()
        if stored in df.columns and name not in df.columns
    }
    df = df.withColumnsRenamed(renames)
    if "txn_date" not in df.columns and "txn_ts" in df.columns:
        df = df.withColumn("txn_date", F.col("txn_ts").cast("date"))
    return ensure_columns(df, [T.StructField("unit_cost", T.DoubleType())])
