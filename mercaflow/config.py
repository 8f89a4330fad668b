"""Job parameters and table layout."""
from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass, field, fields
from datetime import datetime, timezone

from mercaflow.operators.kpis import DEFAULT_COST_FACTOR
from mercaflow.operators.weather import BROADCAST_BYTES


@dataclass(frozen=True)
class TransactionFeed:
    """One raw transaction feed; ``schema`` (DDL) saves the inference pass."""

    name: str
    multiline: bool = True
    schema: str | None = None

    def raw_path(self, base: str, run_date: str) -> str:
        return f"{base}/raw/{self.name}/ingestion_date={run_date}/*"


# Feed names, which are also their folders under raw/ and bronze/.
TRANSACTION_FEEDS = (TransactionFeed("patagonia"), TransactionFeed("riohacha"))
WEATHER_FEED = "openmeteo"

# Columns whose NULLs are counted on ingestion.
TRANSACTION_REQUIRED = ("txn_id", "transaction_id", "id")
WEATHER_REQUIRED = ("time", "timestamp")


@dataclass(frozen=True)
class GoldTable:
    path: str
    partition_by: tuple[str, ...]
    fill: bool = True
    catalog_name: str = ""


# Location and partitioning of the gold tables. NULL partition
# values are filled where ``fill`` is set.
GOLD_TABLES: dict[str, GoldTable] = {
    "top_products_by_category": GoldTable(
        "gold/kpis/top_products_by_category", ("dt", "txn_date", "category")
    ),
    "customer_frequency_ticket": GoldTable(
        "gold/kpis/customer_frequency_ticket", ("dt", "txn_month")
    ),
    "revenue_by_region": GoldTable(
        "gold/kpis/revenue_by_region", ("dt", "period_type", "period_start")
    ),
    "new_vs_returning": GoldTable("gold/kpis/new_vs_returning", ("dt", "txn_month")),
    "price_volume_corr": GoldTable("gold/kpis/price_volume_corr", ("dt",), fill=False),
    "margin_by_product": GoldTable("gold/kpis/margin_by_product", ("dt", "category")),
    "channel_payment_perf": GoldTable(
        "gold/kpis/channel_payment_perf", ("dt", "txn_date", "region")
    ),
    "anomalies": GoldTable("gold/kpis/anomalies", ("dt", "txn_date", "region")),
    "weather_impact": GoldTable("gold/kpis/weather_impact", ("dt",), fill=False),
    "fact_sales_daily": GoldTable(
        "gold/marts/fact_sales_daily",
        ("dt", "txn_date", "region"),
        catalog_name="gold_fact_sales_daily",
    ),
}


def utc_today() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%d")


@dataclass
class JobConfig:
    """Parameters of the three jobs; each field is a command-line flag."""

    input_bucket: str
    run_date: str = field(default_factory=utc_today)
    env: str = "dev"
    shuffle_partitions: int | None = None
    database: str = "sales_medallion"
    raw_prefix: str = "bronze"
    silver_prefix: str = "silver"
    transactions_table: str = "transactions"
    weather_table: str = "weather_daily"
    default_cost_factor: float = DEFAULT_COST_FACTOR
    history_days: int = 0
    exact_distinct: bool = True
    persist_transactions: bool = False
    merge_states: bool = False
    register: bool = True
    feeds: tuple[TransactionFeed, ...] = TRANSACTION_FEEDS
    weather_feed: str = WEATHER_FEED
    weather_multiline: bool = True
    weather_schema: str | None = None
    weather_ledger: bool = False
    weather_broadcast_bytes: int = BROADCAST_BYTES
    spark_conf: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.input_bucket = self.input_bucket.rstrip("/")

    def bronze_path(self, feed: str) -> str:
        return f"{self.input_bucket}/{self.raw_prefix}/{feed}"

    def quarantine_path(self, feed: str) -> str:
        return f"{self.input_bucket}/{self.raw_prefix}/_badrecords/{feed}"

    def ledger_path(self, feed: str) -> str:
        return f"{self.input_bucket}/{self.raw_prefix}/_ledger/{feed}"

    def silver_path(self, table: str) -> str:
        return f"{self.input_bucket}/{self.silver_prefix}/{table}"

    def state_path(self, name: str) -> str:
        return f"{self.input_bucket}/gold/states/{name}"

    def gold_path(self, table: str) -> str:
        return f"{self.input_bucket}/{GOLD_TABLES[table].path}"


def parse_config(description: str, argv: Sequence[str] | None = None) -> JobConfig:
    parser = argparse.ArgumentParser(description=description)
    parser.add_argument("--input_bucket", required=True, help="root of the data lake, any Hadoop URI")
    parser.add_argument("--run_date", help="YYYY-MM-DD, default today (UTC)")
    parser.add_argument("--env", help="deployment tag")
    parser.add_argument("--shuffle_partitions", type=int, help="override of the shuffle partitions")
    parser.add_argument("--database", help="catalog database of the tables")
    parser.add_argument("--raw_prefix", help="folder of the bronze layer")
    parser.add_argument("--silver_prefix", help="folder of the silver layer")
    parser.add_argument("--src_patagonia", help="first transaction feed")
    parser.add_argument("--src_riohacha", help="second transaction feed")
    parser.add_argument("--src_openmeteo", dest="weather_feed", help="weather feed")
    parser.add_argument("--transactions_table")
    parser.add_argument("--weather_table")
    parser.add_argument("--default_cost_factor", type=float, help="share of the price taken as cost")
    parser.add_argument("--history_days", type=int, help="days before run_date the indicators see")
    parser.add_argument(
        "--approx_distinct",
        dest="exact_distinct",
        action="store_false",
        default=None,
        help="count orders and customers with sketches",
    )
    parser.add_argument(
        "--merge_states", action="store_true", default=None, help="derive indicators from stored daily aggregates"
    )
    parser.add_argument("--persist_transactions", action="store_true", default=None)
    parser.add_argument(
        "--weather_ledger", action="store_true", default=None, help="take only weather files that no earlier date took"
    )
    parser.add_argument(
        "--weather_broadcast_bytes", type=int, help="weather beyond this size is attached by a shuffle join"
    )
    parser.add_argument("--no_register", dest="register", action="store_false", default=None)
    parser.add_argument("--json_lines", action="store_true", help="feeds hold one document per line")
    parser.add_argument(
        "--schema", action="append", default=[], metavar="FEED=DDL", help="saves the inference pass over a feed"
    )
    parser.add_argument("--spark_conf", action="append", default=[], metavar="KEY=VALUE")
    args = vars(parser.parse_args(argv))

    names = [args.pop("src_patagonia"), args.pop("src_riohacha")]
    multiline = not args.pop("json_lines")
    schemas = dict(pair.split("=", 1) for pair in args.pop("schema"))
    chosen = [(name or feed.name, feed) for name, feed in zip(names, TRANSACTION_FEEDS)]
    weather = args.get("weather_feed") or WEATHER_FEED
    if unknown := set(schemas) - {name for name, _ in chosen} - {weather}:
        parser.error(f"schema of unknown feeds: {sorted(unknown)}")
    feeds = tuple(TransactionFeed(name, multiline, schemas.get(name, feed.schema)) for name, feed in chosen)
    conf = dict(pair.split("=", 1) for pair in args.pop("spark_conf"))
    given = {f.name: args[f.name] for f in fields(JobConfig) if args.get(f.name) is not None}
    return JobConfig(
        **given, feeds=feeds, weather_multiline=multiline, weather_schema=schemas.get(weather), spark_conf=conf
    )
