"""Indicators merged from daily aggregates against those of all lines."""
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import DataFrameReader, functions as F

from mercaflow.config import JobConfig
from mercaflow.operators import kpis
from mercaflow.operators.transactions import to_silver_names
from mercaflow.operators.weather import attach_weather
from mercaflow.plans.gold import run_gold
from mercaflow.plans.silver import run_silver
from mercaflow.plans.states import NEEDS, STATES, merged_frames, run_dates
from mercaflow.sinks.tables import write_table
from tests.fixtures import line, sales

DAYS = ["2025-10-09", "2025-10-10", "2025-10-11"]


def lines(n=900, seed=6):
    """Lines of three run dates; some lack their region, customer, revenue or cost,
    and a third of them are of one product, day and region."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append(line(
            txn_id=f"T{rng.randrange(n // 2)}",
            txn_date=date(2025, 7, 1) + timedelta(days=0 if hot else rng.randrange(90)),
            region="R1" if hot else rng.choice(["R1", "R2", None]),
            customer_id=rng.choice([None, *(f"C{k}" for k in range(40))]),
            product_id="SKU1" if hot else f"SKU{rng.randrange(6)}",
            category="CatA" if hot else rng.choice(["CatA", "CatB"]),
            quantity=rng.randrange(1, 5),
            unit_price=rng.uniform(1, 90),
            revenue=rng.choice([None, rng.uniform(0, 400), rng.uniform(-5, 5)]),
            unit_cost=rng.choice([None, rng.uniform(1, 9)]),
        ))
    return rows


@pytest.fixture(scope="module")
def all_lines(spark):
    return sales(spark, lines()).withColumn("txn_ts", F.col("txn_date").cast("timestamp")).cache()


@pytest.fixture()
def lake(spark, all_lines, tmp_path):
    config = JobConfig(str(tmp_path), DAYS[-1], history_days=2, merge_states=True, exact_distinct=False, register=False)
    parts = F.pmod(F.xxhash64("txn_id", "quantity"), F.lit(3))
    for number, day in enumerate(DAYS):
        own = to_silver_names(all_lines.filter(parts == number).drop("txn_date"))
        write_table(own, config.silver_path(config.transactions_table), {"run_date": day})
    weather = [(r, date(2025, 7, 1) + timedelta(days=d), float(d % 17), d / 7) for r in ("R1", "R2") for d in range(0, 90, 2)]
    frame = spark.createDataFrame(weather, "region string, weather_date date, weather_avg_temp double, weather_precipitation double")
    write_table(frame, config.silver_path(config.weather_table), {"run_date": DAYS[-1]})
    return config


def rounded(df):
    doubles = [c for c, t in df.dtypes if t == "double"]
    return sorted(map(tuple, df.withColumns({c: F.round(c, 6) for c in doubles}).collect()), key=str)


def weather_of(spark, config):
    return spark.read.parquet(config.silver_path(config.weather_table)).drop("run_date")


def test_merged_tables_equal_those_of_all_lines(spark, lake, all_lines):
    weather = weather_of(spark, lake)
    merged = merged_frames(spark, lake, NEEDS, weather)
    days = kpis.region_days(all_lines)
    expected = {
        "top_products_by_category": kpis.top_products_by_category(all_lines),
        "margin_by_product": kpis.margin_by_product(all_lines),
        "anomalies": kpis.anomalies(all_lines),
        "new_vs_returning": kpis.new_vs_returning(all_lines),
        "weather_impact": kpis.weather_impact_of_days(attach_weather(days, weather)),
    }
    assert set(merged) == set(NEEDS)
    for name, frame in expected.items():
        assert rounded(merged[name]()) == rounded(frame), name


def test_a_merged_sketch_equals_that_of_the_lines(spark, lake, all_lines):
    merged = merged_frames(spark, lake, ["revenue_by_region"], None)["revenue_by_region"]()
    periods = all_lines.groupBy("region", kpis.month().alias("period_start"))
    direct = periods.agg(F.hll_sketch_agg("txn_id").alias("s"), F.count_distinct("txn_id").alias("exact"))
    direct = {(r.region, r.period_start): (r.estimate, r.exact) for r in direct.select(
        "region", "period_start", F.hll_sketch_estimate("s").alias("estimate"), "exact").collect()}
    months = {(r.region, r.period_start): r.monthly_orders for r in merged.filter("period_type = 'monthly'").collect()}
    assert months == {key: estimate for key, (estimate, _) in direct.items()}
    assert all(abs(estimate - exact) <= max(1, 0.05 * exact) for estimate, exact in direct.values())


def test_exact_counts_are_not_merged(spark, lake):
    exact = JobConfig(**{**lake.__dict__, "exact_distinct": True})
    assert "revenue_by_region" not in merged_frames(spark, exact, NEEDS, None)


def test_lines_of_earlier_dates_are_not_read_again(spark, lake, monkeypatch):
    read = []
    original = DataFrameReader.parquet

    def parquet(self, *paths, **options):
        read.extend(p for p in paths if "silver/transactions" in p)
        return original(self, *paths, **options)

    monkeypatch.setattr(DataFrameReader, "parquet", parquet)
    tables = [t for t in NEEDS if NEEDS[t] == "product_days"]
    merged_frames(spark, lake, tables, None)
    assert sorted(p[-10:] for p in read) == DAYS  # four tables, one scan of each date
    read.clear()
    merged_frames(spark, lake, tables, None)
    assert [p[-10:] for p in read] == DAYS[-1:]
    read.clear()
    other = JobConfig(**{**lake.__dict__, "default_cost_factor": 0.5})
    merged_frames(spark, other, ["margin_by_product"], None)
    assert sorted(p[-10:] for p in read) == DAYS  # another factor, other aggregates


def test_the_gold_job_over_three_dates(spark, lake):
    plain = JobConfig(**{**lake.__dict__, "merge_states": False})
    tables = ["margin_by_product", "new_vs_returning", "weather_impact"]
    stored = {}
    for config in (plain, lake):
        run_gold(spark, config, tables)
        stored[config.merge_states] = [rounded(spark.read.parquet(config.gold_path(t))) for t in tables]
    assert stored[True] == stored[False] and all(stored[True])


def test_new_silver_rows_drop_the_aggregates_of_their_date(spark, lake):
    merged_frames(spark, lake, ["margin_by_product"], None)
    path = lake.state_path("product_days")
    assert spark.read.parquet(path).select("dt").distinct().count() == 3
    middle = JobConfig(**{**lake.__dict__, "run_date": DAYS[1]})
    run_silver(spark, middle)  # there is no bronze row of that date
    assert sorted(str(r.dt) for r in spark.read.parquet(path).select("dt").distinct().collect()) == [DAYS[0], DAYS[2]]
    assert run_dates(spark, lake) == [DAYS[0], DAYS[2]]
    margin = merged_frames(spark, lake, ["margin_by_product"], None)["margin_by_product"]()
    left = spark.read.parquet(lake.silver_path(lake.transactions_table))
    assert margin.agg(F.sum("items_sold")).first()[0] == left.agg(F.sum("cantidad")).first()[0]


def test_no_state_without_need(spark, lake):
    assert merged_frames(spark, lake, ["fact_sales_daily", "price_volume_corr"], None) == {}
    assert set(NEEDS.values()) == set(STATES)
