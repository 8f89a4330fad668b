"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables and ``BENCH_CPUS`` the local cores. Each
query runs twice, in full, into the no-op sink; the better time counts.
"""
from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercaflow.workload.registry import fact_with_weather, queries  # noqa: E402

HEADLINE = [
    "silver_union",
    "top_products_by_category",
    "customer_frequency_ticket",
    "revenue_by_region",
    "new_vs_returning",
    "price_volume_corr",
    "margin_by_product",
    "channel_payment_perf",
    "anomalies",
    "weather_daily",
    "weather_hourly",
    "attach_weather",
    "weather_impact",
    "medallion_margin_by_product",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    selected = {name: registered[name] for name in HEADLINE}
    selected["fact_sales_daily"] = fact_with_weather
    run(spark.read.parquet(f"{sf_dir}/nation.parquet"))

    seconds = {}
    for name, query in selected.items():
        times = []
        for _ in range(2):
            start = time.perf_counter()
            run(query(spark, sf_dir))
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
