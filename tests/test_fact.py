import pytest
from pyspark.sql import functions as F

from mercaflow.operators.fact import fact_sales_daily
from mercaflow.operators.weather import attach_weather
from tests.fixtures import DAY, line, sales

WEATHER = "region string, weather_date date, weather_avg_temp double, weather_precipitation double, weather_code string"


@pytest.mark.parametrize("exact", [True, False])
def test_fact_row_and_mixes(spark, exact):
    fact = fact_sales_daily(sales(spark), exact=exact)
    row = fact.filter((F.col("txn_date") == DAY) & (F.col("region") == "North")).first()
    assert (row.orders, row.items_sold, row.revenue, row.unique_customers, row.avg_ticket) == (2, 3, 105.0, 2, 52.5)
    assert row.channel_mix == {"web": 60.0, "shop": 45.0}
    assert row.payment_mix == {"card": 60.0, "cash": 45.0}
    assert row.weather_avg_temp is None and row.weather_code is None
    assert fact.count() == 5


@pytest.mark.parametrize("exact", [True, False])
def test_fact_with_null_keys_and_dimensions(spark, exact):
    lines = [
        line(txn_id="A", region=None, store_id=None, category=None, channel=None, payment_method=None),
        line(txn_id="B", region=None, store_id=None, category=None, channel="online", revenue=None),
        line(txn_id=None, customer_id=None, region=None, store_id=None, category=None, revenue=7.0),
    ]
    rows = fact_sales_daily(sales(spark, lines), exact=exact).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.orders, row.unique_customers, row.items_sold, row.revenue) == (2, 1, 3, 107.0)
    assert row.channel_mix == {"online": 7.0, "unknown": 100.0}
    assert row.payment_mix == {"card": 7.0, "unknown": 100.0}


def test_fact_without_orders_has_zero_ticket(spark):
    row = fact_sales_daily(sales(spark, [line(txn_id=None)]), exact=True).first()
    assert (row.orders, row.avg_ticket) == (0, 0.0)


def test_mix_of_only_null_revenue_is_null(spark):
    row = fact_sales_daily(sales(spark, [line(revenue=None)]), exact=True).first()
    assert row.channel_mix == {"online": None} and row.revenue is None


@pytest.mark.parametrize("exact", [True, False])
def test_distinct_orders_within_a_channel_and_across_channels(spark, exact):
    lines = [line(txn_id="A", channel=c, customer_id=k) for c in ("x", "x", "y") for k in ("C1", "C2")]
    row = fact_sales_daily(sales(spark, lines), exact=exact).first()
    assert (row.orders, row.unique_customers, row.items_sold) == (1, 2, 6)
    assert row.channel_mix == {"x": 400.0, "y": 200.0}


@pytest.mark.parametrize("exact", [True, False])
def test_weather_table_and_weather_on_lines_agree(spark, exact):
    weather = spark.createDataFrame([("North", DAY, 4.5, 0.25, "45")], WEATHER)
    attached = fact_sales_daily(sales(spark), weather, exact)
    lines = attach_weather(sales(spark), weather)
    on_lines = fact_sales_daily(lines, exact=exact)
    assert attached.columns == on_lines.columns
    assert sorted(map(str, attached.collect())) == sorted(map(str, on_lines.collect()))
    row = attached.filter(F.col("weather_code").isNotNull()).first()
    assert (row.weather_avg_temp, row.weather_precipitation, row.weather_code) == (4.5, 0.25, "45")


def test_fact_scans_the_lines_once_and_joins_nothing(spark, tmp_path):
    sales(spark).write.parquet(str(tmp_path / "sales"))
    fact = fact_sales_daily(spark.read.parquet(str(tmp_path / "sales")), exact=True)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan


def test_fact_column_order(spark):
    assert fact_sales_daily(sales(spark)).columns == [
        "txn_date", "region", "store_id", "category", "orders", "items_sold", "revenue",
        "unique_customers", "weather_avg_temp", "weather_precipitation", "weather_code",
        "weather_wind_speed", "weather_humidity", "avg_ticket", "channel_mix", "payment_mix",
    ]


@pytest.mark.parametrize("exact", [True, False])
def test_weather_on_lines_does_not_sort_the_lines(spark, exact):
    weather = spark.createDataFrame([("North", DAY, 4.5, 0.25, "45")], WEATHER)
    lines = attach_weather(sales(spark), weather, by_region=True).drop("weather_humidity")
    plan = fact_sales_daily(lines, exact=exact)._jdf.queryExecution().executedPlan().toString()
    above_the_join = plan[: plan.index("Join")]
    assert "SortAggregate" not in above_the_join


def test_lines_of_one_mix_with_different_codes_are_summed(spark):
    lines = sales(spark, [line(), line(txn_id="T2")]).withColumn("weather_code", F.col("txn_id"))
    row = fact_sales_daily(lines).first()
    assert (row.channel_mix, row.weather_code, row.orders) == ({"online": 200.0}, "L1", 2)


def test_a_mix_of_very_many_values(spark):
    """Two thousand channels of one fact row, a payment method each for most."""
    rows = [
        line(txn_id=f"T{i}", channel=f"c{i % 2000}", payment_method=f"p{i % 1999}", revenue=None if i % 7 == 0 else i / 4)
        for i in range(6000)
    ]
    df = fact_sales_daily(sales(spark, rows))
    fact, keys = df.first(), df.select(F.map_keys("channel_mix"), F.map_keys("payment_mix")).first()
    assert all(list(k) == sorted(k) for k in keys)
    for mix, values in ((fact.channel_mix, 2000), (fact.payment_mix, 1999)):
        prefix, expected = next(iter(mix))[0], {}
        for i in range(6000):
            key = f"{prefix}{i % values}"
            expected[key] = expected.get(key) if i % 7 == 0 else (expected.get(key) or 0.0) + i / 4
        assert mix == expected
