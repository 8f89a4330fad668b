"""Gold job: nine indicators and the daily sales fact."""
from __future__ import annotations

import logging
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from mercaflow.config import GOLD_TABLES, JobConfig, parse_config
from mercaflow.operators import kpis
from mercaflow.operators.fact import fact_sales_daily
from mercaflow.operators.weather import WeatherKeys, attach_weather, look_at
from mercaflow.plans.common import register, run_job
from mercaflow.plans.states import merged_frames
from mercaflow.session import setting, sort_partitions
from mercaflow.sinks.swap import recover
from mercaflow.sinks.tables import clear_owned, fill_partitions, write_table
from mercaflow.sources.tables import load_transactions, load_weather

logger = logging.getLogger(__name__)
# The gold tables that weather is attached to.
WITH_WEATHER = {"weather_impact", "fact_sales_daily"}
DEALT_BY_FOLDER = {"fact_sales_daily"}
# Silver bytes a task reads at once. Exact counts of orders aggregate by order in
# the task that reads, which spills when it holds the orders of a split of 128 MB.
READ_BYTES = "16m"


def gold_frames(
    sales: DataFrame,
    weather: DataFrame | None,
    config: JobConfig,
    look: WeatherKeys | None = None,
    partitions: int | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """Each gold table's frame, built when called; ``look`` is the run's one look
    at the weather, ``partitions`` the tasks that sort the lines of the fact.

    Weather reaches only the two tables that use it, so the other eight scan
    nothing but their own columns of the silver table.
    """
    exact, limit = config.exact_distinct, config.weather_broadcast_bytes
    return {
        "top_products_by_category": lambda: kpis.top_products_by_category(sales),
        "customer_frequency_ticket": lambda: kpis.customer_frequency_ticket(sales, exact),
        "revenue_by_region": lambda: kpis.revenue_by_region(sales, exact),
        "new_vs_returning": lambda: kpis.new_vs_returning(sales),
        "price_volume_corr": lambda: kpis.price_volume_corr(sales),
        "margin_by_product": lambda: kpis.margin_by_product(sales, config.default_cost_factor),
        "channel_payment_perf": lambda: kpis.channel_payment_perf(sales, exact),
        "anomalies": lambda: kpis.anomalies(sales),
        "weather_impact": lambda: kpis.weather_impact_of_days(
            attach_weather(kpis.region_days(sales), weather, look=look, broadcast_bytes=limit)
        ),
        "fact_sales_daily": lambda: fact_sales_daily(
            sales, weather, exact, look, limit, partitions, _folders("fact_sales_daily")
        ),
    }


def _folders(name: str) -> list[str]:
    """The columns that split a run date's folder of a gold table."""
    return [c for c in GOLD_TABLES[name].partition_by if c != "dt"]


def write_gold(df: DataFrame, name: str, config: JobConfig) -> dict[str, int]:
    table = GOLD_TABLES[name]
    if table.fill:
        df = fill_partitions(df)
    # Rows of the fact are made where their folder is written: no second shuffle.
    options = {"rebalance": False} if name in DEALT_BY_FOLDER else {}
    with setting(df.sparkSession, "spark.sql.files.maxPartitionBytes", READ_BYTES):
        return write_table(df, config.gold_path(name), {"dt": config.run_date}, _folders(name), **options)


def sales_paths(config: JobConfig) -> list[str]:
    """The silver folders a run reads; with a history, the whole table bounds them."""
    sales = config.silver_path(config.transactions_table)
    return [sales if config.history_days else f"{sales}/run_date={config.run_date}"]


def run_gold(
    spark: SparkSession, config: JobConfig, tables: Sequence[str] = tuple(GOLD_TABLES)
) -> dict[str, dict[str, int]]:
    """Write and register the gold tables; returns the metrics of each.

    The silver table is columnar, so ten pruned scans read less than one
    cached copy of all columns would write; ``persist_transactions`` caches
    it all the same, for a silver table that is small or slow to read.
    With ``merge_states`` six of the tables are merged from daily aggregates that
    are stored per run date (``plans.states``): lines of earlier dates are not
    read again, and those of this date once for each aggregate.
    """
    for table in (config.transactions_table, config.weather_table):
        recover(spark, config.silver_path(table))
    sales = load_transactions(
        spark, config.silver_path(config.transactions_table), config.run_date, config.history_days
    )
    if sales is None:
        logger.warning("no silver transactions for %s", config.run_date)
        for name in tables:
            clear_owned(spark, config.gold_path(name), {"dt": config.run_date})
        return {}
    weather = load_weather(
        spark, config.silver_path(config.weather_table), config.run_date, config.history_days
    )
    look = look_at(weather) if weather is not None and WITH_WEATHER & set(tables) else None
    if config.persist_transactions:
        sales.persist()
    results = {}
    try:
        partitions = sort_partitions(spark, sales_paths(config)) if "fact_sales_daily" in tables else None
        frames = gold_frames(sales, weather, config, look, partitions)
        if config.merge_states:
            frames |= merged_frames(spark, config, tables, weather, look)
        for name in tables:
            results[name] = write_gold(frames[name](), name, config)
            logger.info("gold %s: %s", name, results[name])
            catalog_name = GOLD_TABLES[name].catalog_name or f"gold_kpi_{name}"
            register(spark, config, catalog_name, config.gold_path(name), {"dt": config.run_date})
    finally:
        if config.persist_transactions:
            sales.unpersist()
    return results


def main(argv: Sequence[str] | None = None) -> int:
    config = parse_config("Gold analytics", argv)
    return run_job("gold_analytics", config, run_gold, inputs=sales_paths(config))


if __name__ == "__main__":
    sys.exit(main())
