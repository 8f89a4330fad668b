"""What the three job entry points share."""
from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import SparkSession

from mercaflow.config import JobConfig
from mercaflow.session import build_session, size_shuffles
from mercaflow.sinks.catalog import register_table


def register(spark: SparkSession, config: JobConfig, name: str, location: str, owned: Mapping[str, str]) -> None:
    if config.register:
        register_table(spark, name, location, config.database, owned)


def run_job(
    name: str,
    config: JobConfig,
    job: Callable[[SparkSession, JobConfig], dict],
    inputs: Sequence[str],
) -> int:
    """Run one job in its session; 1 when it found nothing to write.

    ``inputs`` are the paths whose size decides the shuffle partitions.
    """
    logging.basicConfig(
        level=logging.INFO, format="%(asctime)s %(levelname)s [%(name)s] %(message)s"
    )
    spark = build_session(name, config.spark_conf)
    size_shuffles(spark, inputs, config.shuffle_partitions)
    results = job(spark, config)
    logging.getLogger(name).info("%s (%s) done for %s: %s", name, config.env, config.run_date, results)
    return 0 if results else 1
