"""Session for the jobs, and the shared folder for intermediate tables."""
from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The smallest number of shuffle partitions, the input each one is
# meant for, and the input of a task that sorts whole lines.
MIN_SHUFFLE_PARTITIONS = 200
SHUFFLE_INPUT_BYTES = 64 * 1024 * 1024
SORT_INPUT_BYTES = 4 * 1024 * 1024
# Spark's setting by which the shuffle files of a query go as the query ends.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session without a master: ``spark-submit`` decides where the job runs.

    ``conf`` passes any further setting through, such as object-store access
    (``spark.hadoop.fs.s3a.*``).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def size_shuffles(spark: SparkSession, paths: Iterable[str], override: int | None = None) -> int:
    """Set the shuffle partitions from the size of the input files.

    Adaptive execution joins partitions that turn out small but cannot raise
    their number, so a large input has to ask for enough of them beforehand.
    File lengths come from the file system; no file is opened.
    """
    if override:
        partitions = override
    else:
        total = sum(input_bytes(spark, path) for path in paths)
        partitions = max(MIN_SHUFFLE_PARTITIONS, math.ceil(total / SHUFFLE_INPUT_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    return partitions


def sort_partitions(spark: SparkSession, paths: Iterable[str]) -> int:
    """Tasks for a step that sorts whole lines of the input files. Adaptive
    execution would join them by their packed bytes, a small part of what sorting
    holds, until they spill; a number that is asked for stays."""
    total = sum(input_bytes(spark, path) for path in paths)
    return max(spark.sparkContext.defaultParallelism, math.ceil(total / SORT_INPUT_BYTES))


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that are run inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def input_bytes(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``, which may hold wildcards, by the file system's own
    summaries: one call per match, no task."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sum(files.getContentSummary(match.getPath()).getLength() for match in files.globStatus(where) or [])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where
    that is unset; executors see both."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_intermediate"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
