"""Stored bronze and silver tables."""
from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from mercaflow.operators.transactions import to_gold_names
from mercaflow.schemas import CORRUPT_COLUMN
from mercaflow.sources.feeds import try_read
from mercaflow.sources.ledger import latest_deliveries


def read_partition(
    spark: SparkSession, root: str, column: str, value: str, merge_schema: bool = False
) -> DataFrame | None:
    """One partition of a table with all its partition columns, or None.

    ``basePath`` keeps the columns coded in the directory names; only the
    partition's own files are listed and, when merging, opened for schemas.
    """
    reader = spark.read.options(basePath=root, mergeSchema=merge_schema)
    df = try_read(lambda: reader.parquet(f"{root}/{column}={value}"))
    return None if df is None else _text_partition(df, column)


def read_run_dates(
    spark: SparkSession, root: str, run_date: str | None, history_days: int = 0
) -> DataFrame | None:
    """A run date of a silver table, with the days before it, or all of it.

    A table stored without the partition directory is filtered by its
    ``run_date`` column, if it has one.
    """
    if run_date and not history_days:
        partition = read_partition(spark, root, "run_date", run_date)
        if partition is not None:
            return partition
    df = try_read(lambda: spark.read.parquet(root))
    if df is None:
        return None
    df = _text_partition(df, "run_date")
    if run_date and "run_date" in df.columns:
        first = date.fromisoformat(run_date) - timedelta(days=history_days)
        df = df.filter(F.col("run_date").between(first.isoformat(), run_date))
    return df


def read_bronze(spark: SparkSession, root: str, run_date: str) -> DataFrame | None:
    """Bronze rows of one ingestion date; schema drift between files is merged.
    The corrupt column, null in all of them, is left out."""
    df = read_partition(spark, root, "ingestion_date", run_date, merge_schema=True)
    return None if df is None else df.drop(CORRUPT_COLUMN)


def read_bronze_until(spark: SparkSession, root: str, run_date: str) -> DataFrame | None:
    """Bronze rows of all ingestion dates up to one, each file as it was last."""
    df = try_read(lambda: spark.read.option("mergeSchema", True).parquet(root))
    if df is None:
        return None
    df = _text_partition(df, "ingestion_date").filter(F.col("ingestion_date") <= run_date)
    return latest_deliveries(df.drop(CORRUPT_COLUMN))


def load_transactions(
    spark: SparkSession, root: str, run_date: str | None = None, history_days: int = 0
) -> DataFrame | None:
    """Silver transactions in the engine's names, None if there is no table."""
    df = read_run_dates(spark, root, run_date, history_days)
    return None if df is None else to_gold_names(df)


def load_weather(
    spark: SparkSession, root: str, run_date: str, history_days: int = 0
) -> DataFrame | None:
    """Silver weather, None when the run date has none."""
    if history_days:
        return read_run_dates(spark, root, run_date, history_days)
    return read_partition(spark, root, "run_date", run_date)


def _text_partition(df: DataFrame, column: str) -> DataFrame:
    """Partition dates are inferred as DATE; the tables treat them as text."""
    return df.withColumn(column, F.col(column).cast("string")) if column in df.columns else df
