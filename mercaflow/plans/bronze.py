"""Bronze job: raw feeds with provenance, unreadable records set apart."""
from __future__ import annotations

import logging
import sys
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, Row, SparkSession

from mercaflow.config import (
    TRANSACTION_REQUIRED,
    WEATHER_REQUIRED,
    JobConfig,
    parse_config,
)
from mercaflow.operators.quality import READABLE, ROUTE, UNREADABLE, quality_metrics, with_route
from mercaflow.plans.common import register, run_job
from mercaflow.sinks.swap import discard, put_in_place, recover, stage
from mercaflow.sinks.tables import clear_owned, write_folder
from mercaflow.sources.feeds import list_files, read_files, read_json_source, try_read
from mercaflow.sources.ledger import new_files, record_files

logger = logging.getLogger(__name__)


def run_bronze(spark: SparkSession, config: JobConfig) -> dict[str, dict[str, int]]:
    """Ingest every feed of the run date; returns the metrics of each.

    A feed without files is skipped with a warning.
    """
    results = {}
    for feed in config.feeds:
        path = feed.raw_path(config.input_bucket, config.run_date)
        raw = try_read(
            lambda: read_json_source(
                spark, path, feed.name, config.run_date, feed.schema, feed.multiline
            )
        )
        results[feed.name] = _store(spark, config, feed.name, raw, TRANSACTION_REQUIRED)
    taken = list_weather(spark, config)
    weather = read_weather_files(spark, config, [row.file for row in taken]) if taken else None
    results[config.weather_feed] = _store(
        spark, config, config.weather_feed, weather, WEATHER_REQUIRED
    )
    if config.weather_ledger:
        ledger = config.ledger_path(config.weather_feed)
        if taken:
            record_files(spark, taken, ledger, config.run_date)
        else:
            clear_owned(spark, ledger, {"ingestion_date": config.run_date})
    return {name: metrics for name, metrics in results.items() if metrics}


def list_weather(spark: SparkSession, config: JobConfig) -> list[Row]:
    """The weather files that this run takes: names, which Spark's driver lists to
    read them, with length and time of change. Their folder
    is not split by date: a run takes all of them, or with ``weather_ledger`` only
    those that no run of an earlier date has taken."""
    folder = f"{config.input_bucket}/raw/api/{config.weather_feed}"
    files = try_read(lambda: list_files(spark, f"{folder}/*"))
    if files is None:
        return []
    if config.weather_ledger:
        files = new_files(spark, files, config.ledger_path(config.weather_feed), config.run_date)
    return files.collect()


def read_weather_files(spark: SparkSession, config: JobConfig, files: Sequence[str]) -> DataFrame:
    """Weather files of either format, stamped with the run date."""
    return read_files(
        spark, files, config.weather_feed, config.run_date, config.weather_schema, config.weather_multiline
    )


def _store(
    spark: SparkSession,
    config: JobConfig,
    feed: str,
    raw: DataFrame | None,
    required: Sequence[str],
) -> dict[str, int]:
    path, quarantine = config.bronze_path(feed), config.quarantine_path(feed)
    owned = {"ingestion_date": config.run_date, "source": feed}
    metrics = {} if raw is None else ingest(raw, path, quarantine, owned, required)
    if not metrics.get("records"):
        logger.warning("no data for %s on %s", feed, config.run_date)
        for table in (path, quarantine):
            clear_owned(spark, table, owned)
        return {}
    logger.info("bronze %s: %s", feed, metrics)
    register(spark, config, f"bronze_{feed}", path, owned)
    return metrics


def write_both(df: DataFrame, folder: str) -> None:
    """The two kinds of records side by side. A file of each is open at once, so a
    task streams its records, whatever their number, instead of sorting them."""
    conf, writers = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(writers)
    conf.set(writers, max(int(before), 2))
    try:
        write_folder(df, folder, [ROUTE])
    finally:
        conf.set(writers, before)


def ingest(
    raw: DataFrame,
    path: str,
    quarantine_path: str,
    owned: Mapping[str, str],
    required: Sequence[str] = (),
) -> dict[str, int]:
    """Write readable and unreadable records apart; metrics come with the write.

    The feed is parsed once, by a map-only job that writes both kinds side by
    side, split by a routing column; each folder then takes its place in its own
    table. Both tables are replaced for the ``owned`` date and source. The files
    of both have the corrupt column, which is null in every bronze row.
    """
    spark = raw.sparkSession
    observation = Observation()
    metrics = quality_metrics(raw, required)
    observed = raw.observe(observation, *[expr.alias(name) for name, expr in metrics.items()])
    staged = stage(spark, path, owned)
    recover(spark, quarantine_path, owned)
    try:
        write_both(with_route(observed).drop(*owned), staged)
        counts = observation.get
        put_in_place(spark, path, owned, f"{staged}/{ROUTE}={READABLE}")
        put_in_place(spark, quarantine_path, owned, f"{staged}/{ROUTE}={UNREADABLE}")
    finally:
        discard(spark, path, owned)
    return counts


def main(argv: Sequence[str] | None = None) -> int:
    config = parse_config("Bronze ingestion", argv)
    run_job("bronze_ingest", config, run_bronze, inputs=[])
    return 0  # a day without any feed is no error


if __name__ == "__main__":
    sys.exit(main())
