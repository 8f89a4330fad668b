"""Which files of a feed that is not split by date earlier runs have taken.

A run lists the feed, leaves out by an anti-join what the ledgers of earlier
dates hold unchanged, and reads the rest. Its own ledger is replaced with it, so
a date can be repeated. A file that has changed is new; of several deliveries of
a file the latest counts (:func:`latest_deliveries`).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from mercaflow.sinks.tables import write_table
from mercaflow.sources.feeds import try_read


def new_files(spark: SparkSession, listed: DataFrame, ledger: str, run_date: str) -> DataFrame:
    """The rows of ``listed`` (``file``, ``length``, ``modified``) that no ledger
    of a date before ``run_date`` holds."""
    taken = try_read(lambda: spark.read.parquet(ledger))
    if taken is None:
        return listed
    earlier = taken.filter(F.col("ingestion_date").cast("string") < run_date)
    return listed.join(earlier, ["file", "length", "modified"], "left_anti")


def record_files(spark: SparkSession, taken: Sequence[Row], ledger: str, run_date: str) -> dict[str, int]:
    """Write the ledger of ``run_date``, once its rows are stored."""
    files = spark.createDataFrame(taken, "file string, length long, modified timestamp")
    return write_table(files, ledger, {"ingestion_date": run_date})


def latest_deliveries(bronze: DataFrame) -> DataFrame:
    """Bronze rows of several dates, of each file only those that it had last."""
    latest = bronze.groupBy("file_name").agg(F.max("ingestion_date").alias("ingestion_date"))
    return bronze.join(latest, ["file_name", "ingestion_date"], "left_semi")
