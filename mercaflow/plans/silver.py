"""Silver job: one transaction table and daily weather."""
from __future__ import annotations

import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from mercaflow.config import JobConfig, parse_config
from mercaflow.operators.transactions import to_silver_names, union_feeds
from mercaflow.operators.weather import prepare_weather_features
from mercaflow.plans.common import register, run_job
from mercaflow.plans.states import clear_states
from mercaflow.sinks.swap import recover
from mercaflow.sinks.tables import clear_owned, write_table
from mercaflow.sources.tables import read_bronze, read_bronze_until

logger = logging.getLogger(__name__)


def run_silver(spark: SparkSession, config: JobConfig) -> dict[str, dict[str, int]]:
    """Standardize the run date's bronze rows; returns the metrics per table.

    Standardizing is a narrow projection, so transactions are written by the
    tasks that read them; only the weather rollup shuffles.
    """
    owned = {"run_date": config.run_date}
    results = {}
    for feed in (*(f.name for f in config.feeds), config.weather_feed):
        recover(spark, config.bronze_path(feed))

    clear_states(spark, config)
    transactions = union_feeds(
        read_bronze(spark, config.bronze_path(feed.name), config.run_date) for feed in config.feeds
    )
    if transactions is None:
        logger.warning("no transactions in bronze for %s", config.run_date)
        clear_owned(spark, config.silver_path(config.transactions_table), owned)
    else:
        results[config.transactions_table] = write_table(
            to_silver_names(transactions), config.silver_path(config.transactions_table), owned, rebalance=False
        )

    # With a ledger, a date's bronze weather is what it was the first to take.
    read_weather = read_bronze_until if config.weather_ledger else read_bronze
    weather = read_weather(spark, config.bronze_path(config.weather_feed), config.run_date)
    if weather is None:
        logger.info("no weather in bronze for %s", config.run_date)
        clear_owned(spark, config.silver_path(config.weather_table), owned)
    else:
        daily = prepare_weather_features(weather)
        results[config.weather_table] = write_table(daily, config.silver_path(config.weather_table), owned)

    for table, metrics in results.items():
        logger.info("silver %s: %s", table, metrics)
        register(spark, config, f"silver_{table}", config.silver_path(table), owned)
    return results


def main(argv: Sequence[str] | None = None) -> int:
    config = parse_config("Silver transformation", argv)
    weather = f"{config.bronze_path(config.weather_feed)}/ingestion_date={config.run_date}"
    return run_job("silver_transform", config, run_silver, inputs=[weather])


if __name__ == "__main__":
    sys.exit(main())
