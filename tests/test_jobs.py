import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from mercaflow.config import GOLD_TABLES, JobConfig, parse_config
from mercaflow.plans import bronze, gold, silver

DAY1, DAY2 = "2025-10-10", "2025-10-11"


def english(txn, day, qty, price, **more):
    return {
        "transaction_id": txn, "transaction_ts": f"{day}T10:00:00", "store_id": "S1", "region": "R1",
        "product_id": "SKU1", "product_name": "Prod 1", "category": "Cat A/B", "quantity": qty,
        "unit_price": price, "customer_id": "C1", "channel": "online", "payment_method": "card", **more,
    }


def spanish(txn, day, qty, price):
    return {
        "id": txn, "datetime": f"{day} 12:34:00", "tienda_id": "S9", "zona": "R2", "sku": "SKU9",
        "item_name": "Prod 9", "categoria": "CatB", "cantidad": qty, "precio": price,
        "cliente_id": "C9", "canal": "tienda", "metodo_pago": "efectivo",
    }


def put(base, feed, day, name, content):
    folder = base / "raw" / feed / f"ingestion_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    text = content if isinstance(content, str) else json.dumps(content)
    (folder / name).write_text(text, encoding="utf-8")


@pytest.fixture(scope="module")
def lake(tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    put(base, "patagonia", DAY1, "a.json", [english("A1", DAY1, 2, 10.0), english("A2", DAY1, 1, 5.0, unit_cost=2.0)])
    put(base, "patagonia", DAY1, "broken.json", '{"transaction_id": "A3", ')
    put(base, "riohacha", DAY1, "b.json", [spanish("B1", DAY1, 3, 4.0)])
    put(base, "patagonia", DAY2, "a.json", [english("A4", DAY2, 1, 7.0)])
    weather = base / "raw" / "api" / "openmeteo"
    weather.mkdir(parents=True)
    (weather / "w.json").write_text(
        json.dumps([
            {"region": "R1", "time": f"{DAY1} 08:00:00", "temperature_2m_mean": 10.0, "precipitation": 1.0, "weathercode": 3},
            {"region": "R1", "time": f"{DAY2} 08:00:00", "temperature_2m_mean": 20.0, "precipitation": 2.0, "weathercode": 4},
        ])
    )
    return base


@pytest.fixture(scope="module")
def results(spark, lake):
    out = {}
    for day in (DAY1, DAY2):
        config = JobConfig(str(lake), day, database="lake_test")
        out[day] = (bronze.run_bronze(spark, config), silver.run_silver(spark, config), gold.run_gold(spark, config))
    yield out
    spark.sql("drop database if exists lake_test cascade")


def test_bronze_metrics_and_quarantine(spark, lake, results):
    counts = results[DAY1][0]
    assert (counts["patagonia"]["records"], counts["patagonia"]["corrupt"]) == (3, 1)
    assert counts["patagonia"]["null_transaction_id"] == 1
    assert (counts["riohacha"]["records"], counts["openmeteo"]["records"]) == (1, 2)
    assert "riohacha" not in results[DAY2][0]
    bad = spark.read.parquet(f"{lake}/bronze/_badrecords/patagonia")
    assert bad.first()._corrupt_record == '{"transaction_id": "A3", '


def test_silver_tables(spark, lake, results):
    assert results[DAY1][1] == {"transactions": {"records": 3}, "weather_daily": {"records": 2}}
    stored = spark.read.parquet(f"{lake}/silver/transactions")
    assert {r.id: r.revenue for r in stored.collect()} == {"A1": 20.0, "A2": 5.0, "B1": 12.0, "A4": 7.0}
    assert {r.source for r in stored.collect()} == {"patagonia", "riohacha"}


def test_gold_tables(spark, lake, results):
    assert set(results[DAY1][2]) == set(GOLD_TABLES)
    fact = spark.read.parquet(f"{lake}/gold/marts/fact_sales_daily").filter(F.col("dt") == DAY1)
    rows = {r.store_id: r for r in fact.collect()}
    assert (rows["S1"].orders, rows["S1"].revenue, rows["S1"].weather_avg_temp, rows["S1"].weather_code) == (2, 25.0, 10.0, "3")
    assert rows["S1"].channel_mix == {"online": 25.0} and rows["S9"].payment_mix == {"efectivo": 12.0}
    assert rows["S9"].weather_avg_temp is None
    margin = spark.read.parquet(f"{lake}/gold/kpis/margin_by_product").filter(F.col("dt") == DAY1)
    assert {r.product_id: r.total_cost for r in margin.collect()} == {"SKU1": 16.0, "SKU9": 8.4}
    region = spark.read.parquet(f"{lake}/gold/kpis/revenue_by_region").filter(F.col("dt") == DAY1)
    assert {r.period_start for r in region.collect()} == {date(2025, 10, 6), date(2025, 10, 1)}


def test_catalog_tables(spark, results):
    names = {t.name for t in spark.catalog.listTables("lake_test")}
    assert {"bronze_patagonia", "bronze_riohacha", "bronze_openmeteo", "silver_transactions",
            "silver_weather_daily", "gold_kpi_anomalies", "gold_fact_sales_daily"} <= names
    assert spark.table("lake_test.gold_fact_sales_daily").count() == 3


def test_repeating_a_date_changes_nothing_else(spark, lake, results):
    config = JobConfig(str(lake), DAY2, database="lake_test")
    bronze.run_bronze(spark, config)
    silver.run_silver(spark, config)
    gold.run_gold(spark, config)
    assert spark.read.parquet(f"{lake}/bronze/patagonia").count() == 3
    assert spark.read.parquet(f"{lake}/silver/transactions").count() == 4
    assert spark.read.parquet(f"{lake}/gold/marts/fact_sales_daily").count() == 3


def test_history_lets_the_indicators_see_earlier_days(spark, lake, results):
    config = JobConfig(str(lake), DAY2, history_days=1, register=False, persist_transactions=True)
    counts = gold.run_gold(spark, config, ["top_products_by_category"])
    assert counts == {"top_products_by_category": {"records": 3}}
    top = spark.read.parquet(f"{lake}/gold/kpis/top_products_by_category").filter(F.col("dt") == DAY2)
    change = top.filter((F.col("product_id") == "SKU1") & (F.col("txn_date") == DAY2)).first().revenue_change_pct
    assert change == (7.0 - 25.0) / 25.0


def test_jobs_without_data(spark, tmp_path):
    config = JobConfig(str(tmp_path), DAY1, register=False)
    assert bronze.run_bronze(spark, config) == {}
    assert silver.run_silver(spark, config) == {}
    assert gold.run_gold(spark, config) == {}


def test_transactions_without_weather(spark, tmp_path):
    put(tmp_path, "riohacha", DAY1, "b.json", spanish("B1", DAY1, 3, 4.0))
    config = JobConfig(str(tmp_path), DAY1, register=False)
    assert set(bronze.run_bronze(spark, config)) == {"riohacha"}
    assert set(silver.run_silver(spark, config)) == {"transactions"}
    counts = gold.run_gold(spark, config, ["weather_impact", "fact_sales_daily"])
    assert counts["fact_sales_daily"] == {"records": 1}
    row = spark.read.parquet(f"{tmp_path}/gold/marts/fact_sales_daily").first()
    assert row.revenue == 12.0 and row.weather_code is None


def test_command_line():
    config = parse_config("x", ["--input_bucket", "s3a://lake/", "--run_date", DAY1])
    assert (config.input_bucket, config.run_date, config.default_cost_factor) == ("s3a://lake", DAY1, 0.7)
    assert [f.name for f in config.feeds] == ["patagonia", "riohacha"]
    assert config.quarantine_path("patagonia") == "s3a://lake/bronze/_badrecords/patagonia"
    config = parse_config("x", [
        "--input_bucket", "b", "--src_riohacha", "caribe", "--src_openmeteo", "meteo", "--json_lines",
        "--default_cost_factor", "0.5", "--shuffle_partitions", "64", "--silver_prefix", "s", "--raw_prefix", "r",
        "--transactions_table", "t", "--weather_table", "w", "--approx_distinct", "--no_register", "--env", "prod",
        "--spark_conf", "spark.hadoop.fs.s3a.endpoint=s3.amazonaws.com",
    ])
    assert [f.name for f in config.feeds] == ["patagonia", "caribe"] and not config.feeds[0].multiline
    assert (config.shuffle_partitions, config.default_cost_factor, config.exact_distinct) == (64, 0.5, False)
    assert (config.register, config.env, config.weather_feed) == (False, "prod", "meteo")
    assert config.spark_conf == {"spark.hadoop.fs.s3a.endpoint": "s3.amazonaws.com"}
    assert (config.silver_path(config.weather_table), config.bronze_path("x")) == ("b/s/w", "b/r/x")
    assert len(config.run_date) == 10


def test_weather_is_read_once_with_a_ledger(spark, tmp_path):
    folder = tmp_path / "raw" / "api" / "openmeteo"
    folder.mkdir(parents=True)

    def deliver(name, *readings):
        rows = [{"region": r, "time": f"{d} 08:00:00", "temperature_2m_mean": t} for r, d, t in readings]
        (folder / name).write_text(json.dumps(rows), encoding="utf-8")

    def run(day):
        config = JobConfig(str(tmp_path), day, register=False, weather_ledger=True)
        counts = bronze.run_bronze(spark, config).get("openmeteo", {}).get("records")
        silver.run_silver(spark, config)
        stored = spark.read.parquet(f"{tmp_path}/silver/weather_daily").filter(F.col("run_date") == day)
        return counts, {(r.region, str(r.weather_date)): r.weather_avg_temp for r in stored.collect()}

    deliver("a.json", ("R1", DAY1, 1.0), ("R1", DAY1, 3.0))
    assert run(DAY1) == (2, {("R1", DAY1): 2.0})
    deliver("b.json", ("R1", DAY1, 5.0), ("R2", DAY2, 7.0))
    everything = {("R1", DAY1): 3.0, ("R2", DAY2): 7.0}
    assert run(DAY2) == (2, everything)
    assert run(DAY2) == (2, everything)  # a repeated date takes its own files again
    deliver("a.json", ("R1", DAY1, 10.0))
    assert run("2025-10-12") == (1, {("R1", DAY1): 7.5, ("R2", DAY2): 7.0})
    assert run("2025-10-13") == (None, {("R1", DAY1): 7.5, ("R2", DAY2): 7.0})
