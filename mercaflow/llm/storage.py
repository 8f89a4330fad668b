"""Intermediate tables in the folder that driver and executors share."""
from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from mercaflow.session import SHUFFLES_GO, setting


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset (as in
    tests), below the warehouse, which executors see as well."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for tables that nothing reads after the block, which deletes them."""
    folder = shared_path(spark, name)
    try:
        yield folder
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """``df`` written once, below ``folder`` if given, and read back: lineage is
    cut, and a lost executor costs nothing that was computed before. What was
    shuffled for it goes when it is written: nothing else reads that."""
    spark = df.sparkSession
    path = f"{folder}/{name}-{uuid.uuid4().hex}" if folder else shared_path(spark, name)
    with setting(spark, SHUFFLES_GO, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
