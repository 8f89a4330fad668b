from datetime import date

import pytest
from pyspark.sql import functions as F

from mercaflow.operators import weather as W
from mercaflow.operators.kpis import region_days, weather_impact, weather_impact_of_days
from tests.fixtures import DAY, NEXT, line, sales

COLUMNS = [
    "region", "weather_date", "weather_avg_temp", "weather_precipitation", "weather_code",
    "weather_wind_speed", "weather_humidity",
]
WEATHER = "region string, weather_date date, weather_avg_temp double, weather_precipitation double, weather_code string"


def test_daily_readings(spark):
    df = spark.createDataFrame(
        [("Delta", "2024-06-01 05:30:00", 11.0, 2.5, 61), ("Delta", "2024-06-01 22:15:00", 18.0, 0.0, 3)],
        "region string, time string, temperature_2m_mean double, precipitation double, weathercode bigint",
    )
    out = W.prepare_weather_features(df)
    assert out.columns == COLUMNS
    assert out.collect() == [("Delta", date(2024, 6, 1), 14.5, 1.25, "61", None, None)]


def test_daily_text_metrics_aliases_and_bad_values(spark):
    df = spark.createDataFrame(
        [("P", "2025-10-11", "1.5", None, "2.0"), ("P", "2025-10-11", "bad", "4.0", "9.0")],
        "city string, date string, temp_mean string, precipitation string, precipitation_sum string",
    )
    row = W.prepare_weather_features(df).first()
    assert (row.region, row.weather_avg_temp, row.weather_precipitation) == ("P", 1.5, 3.0)
    assert row.weather_code is None


def hourly(spark, rows, metrics="temperature_2m array<double>, precipitation array<double>, wind_speed_10m array<double>, relative_humidity_2m array<double>, weathercode array<bigint>"):
    return spark.createDataFrame(rows, f"region string, time array<string>, {metrics}")


def test_hourly_arrays_over_two_days(spark):
    times = ["2025-10-11T00:00", "2025-10-11T12:00", "2025-10-12T00:00"]
    df = hourly(spark, [("R", times, [1.0, 3.0, 5.0], [0.5], [10.0, 20.0, 30.0], [50.0, None, 70.0], [3, 1, 2])])
    rows = {r.weather_date: tuple(r[2:]) for r in W.prepare_weather_features(df).collect()}
    assert rows == {
        date(2025, 10, 11): (2.0, 0.5, "3", 15.0, 50.0),
        date(2025, 10, 12): (5.0, None, "2", 30.0, 70.0),
    }


def test_hourly_without_some_or_any_metrics(spark):
    one = hourly(spark, [("R", ["2025-10-11T00:00"], [1.0]), ("R", None, None)], "temperature_2m array<double>")
    assert W.prepare_weather_features(one).collect() == [("R", date(2025, 10, 11), 1.0, None, None, None, None)]
    none = hourly(spark, [("R", ["2025-10-11T00:00", "2025-10-11T01:00"], 1)], "other int")
    assert W.prepare_weather_features(none).collect() == [("R", date(2025, 10, 11), None, None, None, None, None)]


def test_hourly_struct_is_flattened(spark):
    df = spark.sql(
        "select 'R' as name, named_struct('time', array('2025-10-11T00:00'), 'temperature_2m', array(2.5D)) as hourly"
    )
    assert W.prepare_weather_features(df).first()[:3] == ("R", date(2025, 10, 11), 2.5)


def test_code_is_the_earliest_known_one(spark):
    rows = [("R", "2025-10-11 05:00:00", None), ("R", "2025-10-11 09:00:00", 9), ("R", "2025-10-11 07:00:00", 7)]
    df = spark.createDataFrame(rows, "region string, time string, weathercode bigint")
    assert W.prepare_weather_features(df).first().weather_code == "7"


def test_without_time_the_ingestion_date_counts(spark):
    df = spark.createDataFrame([("R", "2025-10-11"), ("R", "2025-10-11")], "region string, ingestion_date string")
    assert W.prepare_weather_features(df).collect() == [("R", date(2025, 10, 11), None, None, None, None, None)]


def test_without_region_column(spark):
    df = spark.createDataFrame([("2025-10-11", 1.0)], "time string, avg_temp double")
    assert W.prepare_weather_features(df).first()[:3] == (None, date(2025, 10, 11), 1.0)


def test_attach_by_region(spark):
    weather = spark.createDataFrame([("North", DAY, 1.0, 2.0, "c"), ("South", NEXT, 9.0, 9.0, "d")], WEATHER)
    out = W.attach_weather(sales(spark), weather)
    assert out.count() == 7
    temps = {r.txn_id: r.weather_avg_temp for r in out.collect()}
    assert temps == {"K1": 1.0, "K2": None, "K3": None, "K4": None, "K5": None, "K6": 1.0}
    assert out.columns[-5:] == W.METRIC_NAMES


def test_attach_by_date_when_no_region_is_known(spark):
    weather = spark.createDataFrame([(None, DAY, 1.0, 2.0, "c"), (None, DAY, 3.0, None, "b")], WEATHER)
    rows = {r.txn_id: r for r in W.attach_weather(sales(spark), weather).collect()}
    assert len(rows) == 6
    assert (rows["K3"].weather_avg_temp, rows["K3"].weather_precipitation, rows["K3"].weather_code) == (2.0, 2.0, "b")
    assert rows["K4"].weather_avg_temp is None


def test_attach_without_region_column(spark):
    weather = spark.createDataFrame([(NEXT, 7.0)], "weather_date date, weather_avg_temp double")
    rows = {r.txn_id: r.weather_avg_temp for r in W.attach_weather(sales(spark), weather).collect()}
    assert rows["K4"] == 7.0 and rows["K1"] is None


def test_attach_nothing_and_replace_stale_columns(spark):
    bare = W.attach_weather(sales(spark), None)
    assert bare.dtypes[-5:] == [
        ("weather_avg_temp", "double"), ("weather_precipitation", "double"), ("weather_code", "string"),
        ("weather_wind_speed", "double"), ("weather_humidity", "double"),
    ]
    weather = spark.createDataFrame([("North", DAY, 1.0, 2.0, "c")], WEATHER)
    again = W.attach_weather(bare.withColumn("weather_avg_temp", F.lit(99.0)), weather)
    assert again.columns == bare.columns
    assert {r.txn_id: r.weather_avg_temp for r in again.collect()}["K1"] == 1.0


def test_a_weather_table_past_the_limit_is_not_broadcast(spark, monkeypatch):
    weather = spark.createDataFrame([("North", DAY, 1.0, 2.0, "c"), ("North", NEXT, 3.0, 4.0, "d")], WEATHER)
    small = W.attach_weather(sales(spark), weather)
    monkeypatch.setattr(W, "BROADCAST_BYTES", 1)
    large = W.attach_weather(sales(spark), weather)
    assert "ResolvedHint" in small._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in large._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))


def test_weather_impact(spark):
    weather = spark.createDataFrame([("R1", DAY, 1.0, 5.0, "c"), ("R1", NEXT, 3.0, 5.0, "d")], WEATHER)
    lines = [line(txn_date=DAY, revenue=10.0), line(txn_date=NEXT, revenue=30.0), line(txn_date=NEXT, revenue=None)]
    row = weather_impact(W.attach_weather(sales(spark, lines), weather)).first()
    assert round(row.corr_temp_revenue, 9) == 1.0
    assert row.corr_precip_revenue is None
    assert (round(row.avg_temp, 6), row.avg_precip) == (2.333333, 5.0)


def test_impact_by_days_equals_that_of_lines(spark):
    rows, weather = [], []
    for day in range(1, 25):
        at = date(2024, 2, day)
        weather.append(("R1", at, None if day % 7 == 0 else day * 0.5, float(day % 5), "x"))
        weather.append(("R2", at, 3.0, None, "x"))
        for n in range(day % 4 + 1):
            revenue = None if (day + n) % 9 == 0 else 1e6 + day * 3.0 + n * 7.5
            rows += [line(txn_date=at, region=r, revenue=revenue) for r in ("R1", "R2", None)]
    sold = sales(spark, rows)
    daily = spark.createDataFrame(weather, WEATHER)
    by_lines = {r.region: r for r in weather_impact(W.attach_weather(sold, daily)).collect()}
    by_days = {r.region: r for r in weather_impact_of_days(W.attach_weather(region_days(sold), daily)).collect()}
    assert by_days.keys() == by_lines.keys() == {"R1", "R2", None}
    for region, row in by_lines.items():
        for name in ("corr_temp_revenue", "corr_precip_revenue", "avg_temp", "avg_precip"):
            assert by_days[region][name] == (None if row[name] is None else pytest.approx(row[name], rel=1e-6))


def test_one_look_serves_all_attachments(spark):
    weather = spark.createDataFrame([("R1", DAY, 1.0, 2.0, "code"), ("R1", DAY, 3.0, 2.0, None), ("Región", NEXT, 3.0, 4.0, "d")], WEATHER)
    look = W.look_at(weather)
    assert look == W.WeatherKeys(True, 2 * W.ROW_BYTES + 2 + 4 + 7 + 1, 2 * (W.ROW_BYTES + 4))
    assert W.look_at(weather.filter("false")) == W.WeatherKeys(False, 0, 0)
    context = spark.sparkContext
    context.setJobGroup("attachments", "")
    try:
        broadcast = W.attach_weather(sales(spark), weather, look=look)
        shuffled = W.attach_weather(sales(spark), weather, look=look, broadcast_bytes=look.region_day_bytes - 1)
        assert list(context.statusTracker().getJobIdsForGroup("attachments")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    plans = [df._jdf.queryExecution().analyzed().toString() for df in (broadcast, shuffled)]
    assert ["ResolvedHint" in plan for plan in plans] == [True, False]
    assert sorted(map(str, broadcast.collect())) == sorted(map(str, shuffled.collect()))


def test_long_codes_count_in_the_size(spark):
    rows = [(f"R{i}", DAY, 1.0, 2.0, "x" * 10_000) for i in range(20)]
    weather = spark.createDataFrame(rows, WEATHER)
    attached = W.attach_weather(sales(spark), weather, broadcast_bytes=100_000)
    assert "ResolvedHint" not in attached._jdf.queryExecution().analyzed().toString()
