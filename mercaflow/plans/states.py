"""Stored daily aggregates of each run date, from which gold tables are merged.

The gold job writes them for its own date, and for dates of its history that lack
them, in one scan of a date's silver rows each; a date whose silver rows are
replaced loses them, so they are never older than what they sum up. The cost
factor is part of their folder: another factor makes other aggregates.
"""
from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from mercaflow.config import JobConfig
from mercaflow.operators import kpis, states
from mercaflow.operators.weather import WeatherKeys, attach_weather
from mercaflow.sinks.swap import folder_names, owned_path, recover
from mercaflow.sinks.tables import clear_owned, write_table
from mercaflow.sources.tables import load_transactions

logger = logging.getLogger(__name__)
Build = Callable[[DataFrame, JobConfig], DataFrame]

STATES: dict[str, Build] = {
    "product_days": lambda sales, config: states.product_days(sales, config.default_cost_factor),
    "customer_months": lambda sales, config: states.customer_months(sales),
    "region_day_sketches": lambda sales, config: states.region_day_sketches(sales),
}
# The aggregate that each gold table can be merged from.
NEEDS = {
    "top_products_by_category": "product_days",
    "margin_by_product": "product_days",
    "anomalies": "product_days",
    "weather_impact": "product_days",
    "new_vs_returning": "customer_months",
    "revenue_by_region": "region_day_sketches",
}


def merged_frames(
    spark: SparkSession,
    config: JobConfig,
    tables: Iterable[str],
    weather: DataFrame | None,
    look: WeatherKeys | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Frames of those ``tables`` that merge stored aggregates, once these are up
    to date. Exact distinct counts don't merge: regions then count their lines."""
    wanted = [t for t in tables if t in NEEDS and not (t == "revenue_by_region" and config.exact_distinct)]
    of = {name: _state(spark, config, name) for name in dict.fromkeys(NEEDS[t] for t in wanted)}
    frames = {
        "top_products_by_category": lambda: states.top_products(of["product_days"]),
        "margin_by_product": lambda: states.margin(of["product_days"]),
        "anomalies": lambda: states.anomalies(of["product_days"]),
        "weather_impact": lambda: kpis.weather_impact_of_days(
            attach_weather(
                states.region_days(of["product_days"]), weather, look=look, broadcast_bytes=config.weather_broadcast_bytes
            )
        ),
        "new_vs_returning": lambda: states.new_vs_returning(of["customer_months"]),
        "revenue_by_region": lambda: states.revenue_by_region(of["region_day_sketches"]),
    }
    return {t: frames[t] for t in wanted}


def run_dates(spark: SparkSession, config: JobConfig) -> list[str]:
    """The dates of the run and its history that have silver rows."""
    root = config.silver_path(config.transactions_table)
    first = date.fromisoformat(config.run_date) - timedelta(days=config.history_days)
    stored = [name.removeprefix("run_date=") for name in folder_names(spark, root, root) if name.startswith("run_date=")]
    return sorted(d for d in stored if first.isoformat() <= d <= config.run_date)


def _owned(config: JobConfig, day: str) -> dict[str, str]:
    return {"dt": day, "cost_factor": str(config.default_cost_factor)}


def _state(spark: SparkSession, config: JobConfig, name: str) -> DataFrame:
    """One aggregate of all dates of the run, written where it is missing."""
    path, days = config.state_path(name), run_dates(spark, config)
    recover(spark, path)
    for day in days:
        owned = _owned(config, day)
        if day == config.run_date or not folder_names(spark, path, owned_path(path, owned), files=True):
            sales = load_transactions(spark, config.silver_path(config.transactions_table), day)
            counts = write_table(STATES[name](sales, config), path, owned)
            logger.info("state %s of %s: %s", name, day, counts)
    folders = [owned_path(path, _owned(config, day)) for day in days]
    return spark.read.option("basePath", path).parquet(*folders).drop("dt", "cost_factor")


def clear_states(spark: SparkSession, config: JobConfig) -> None:
    """Drop the aggregates of the run date, whose silver rows are replaced."""
    for name in STATES:
        path = config.state_path(name)
        if folder_names(spark, path, path):
            clear_owned(spark, path, {"dt": config.run_date})
