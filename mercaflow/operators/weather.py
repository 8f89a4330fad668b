"""Weather: daily rollup per region, and its attachment to other frames."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from mercaflow.functions.columns import ensure_columns, first_existing_column, named
from mercaflow.schemas import (
    DAILY_NAMES,
    HOURLY_NAMES,
    WEATHER_METRICS,
    WEATHER_REGION_NAMES,
    WEATHER_TIME_NAMES,
)

METRIC_NAMES = WEATHER_METRICS.fieldNames()
DAY_KEYS = ["region", "weather_date"]
CODE = "weather_code"

# Bytes of weather up to which the attachment is broadcast, and what a row takes
# beside its texts: five fields of eight bytes each, and the hashed row's overhead.
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 96


def prepare_weather_features(df: DataFrame) -> DataFrame:
    """One row per region and day from hourly arrays or from daily readings.

    The shape is chosen from the schema: an array time column means hourly
    records. All five metrics are always present, NULL where not supplied.
    """
    df = _flatten_hourly_struct(df)
    time_name = first_existing_column(df, WEATHER_TIME_NAMES)
    if time_name and isinstance(df.schema[time_name].dataType, T.ArrayType):
        readings = _hourly_readings(df, time_name)
    else:
        readings = _daily_readings(df, time_name)

    return ensure_columns(_rollup(readings), WEATHER_METRICS).select(*DAY_KEYS, *METRIC_NAMES)


def _flatten_hourly_struct(df: DataFrame) -> DataFrame:
    """Lift ``hourly.{time, ...}`` of a nested API response to the top level."""
    if "hourly" not in df.columns or not isinstance(df.schema["hourly"].dataType, T.StructType):
        return df
    inner = df.schema["hourly"].dataType.fieldNames()
    outer = [named(c) for c in df.columns if c != "hourly" and c not in inner]
    return df.select(*outer, "hourly.*")


def _region(df: DataFrame) -> Column:
    name = first_existing_column(df, WEATHER_REGION_NAMES)
    return (named(name) if name else F.lit(None)).cast("string").alias("region")


def _hourly_readings(df: DataFrame, time_name: str) -> DataFrame:
    arrays = {
        target: source
        for target, names in HOURLY_NAMES.items()
        if (source := first_existing_column(df, names))
        and isinstance(df.schema[source].dataType, T.ArrayType)
    }
    zipped = F.arrays_zip(
        named(time_name).alias("time"), *[named(s).alias(t) for t, s in arrays.items()]
    )
    exploded = df.select(_region(df), F.explode(zipped).alias("hour"))
    weather_ts = F.col("hour.time").try_cast("timestamp")
    return exploded.select(
        "region",
        weather_ts.alias("weather_ts"),
        weather_ts.cast("date").alias("weather_date"),
        *[_metric(F.col(f"hour.{target}"), target) for target in arrays],
    )


def _daily_readings(df: DataFrame, time_name: str | None) -> DataFrame:
    time = named(time_name) if time_name else F.col("ingestion_date")
    weather_ts = time.try_cast("timestamp")
    metrics = []
    for target, names in DAILY_NAMES.items():
        found = [_metric(named(n), target) for n in names if n in df.columns]
        if found:
            metrics.append(F.coalesce(*found).alias(target))
    return df.select(
        _region(df),
        weather_ts.alias("weather_ts"),
        weather_ts.cast("date").alias("weather_date"),
        *metrics,
    )


def _metric(column: Column, target: str) -> Column:
    return column.try_cast(WEATHER_METRICS[target].dataType).alias(target)


def _rollup(readings: DataFrame) -> DataFrame:
    """Daily averages, and the earliest known code of the day.

    With a code the readings are first grouped by it: that step keeps only
    numbers per group, so it aggregates on hashes, where taking the earliest
    of a text over all readings would sort them.
    """
    averaged = [m for m in METRIC_NAMES if m in readings.columns and m != CODE]
    if CODE not in readings.columns:
        return readings.groupBy(*DAY_KEYS).agg(
            F.count(F.lit(1)).alias("readings"), *[F.avg(m).alias(m) for m in averaged]
        )
    sums = [F.sum(m).alias(f"{m}_sum") for m in averaged]
    counts = [F.count(m).alias(f"{m}_count") for m in averaged]
    by_code = readings.groupBy(*DAY_KEYS, CODE).agg(
        F.min("weather_ts").alias("weather_ts"), *sums, *counts
    )
    earliest = F.min_by(CODE, F.when(F.col(CODE).isNotNull(), F.struct("weather_ts", CODE)))
    averages = [
        F.try_divide(F.sum(f"{m}_sum"), F.sum(f"{m}_count")).alias(m) for m in averaged
    ]
    return by_code.groupBy(*DAY_KEYS).agg(earliest.alias(CODE), *averages)


@dataclass(frozen=True)
class WeatherKeys:
    """What one look at a weather table tells: whether a row names a region, and
    the bytes that the rows to attach take, by region and day and by day."""

    named: bool
    region_day_bytes: int
    day_bytes: int


def look_at(weather: DataFrame) -> WeatherKeys:
    """The look, one action; a run takes it once and passes it on."""
    weather = _complete(weather)
    longest = F.max(F.coalesce(F.octet_length(F.col(CODE).cast("string")), F.lit(0))).alias("code")
    rows = weather.groupBy(*DAY_KEYS).agg(longest)
    region = F.coalesce(F.octet_length("region"), F.lit(0))
    named, region_days, days, code = rows.agg(
        F.count("region"),
        F.coalesce(F.sum(ROW_BYTES + region + F.col("code")), F.lit(0)),
        F.count_distinct("weather_date"),
        F.coalesce(F.max("code"), F.lit(0)),
    ).first()
    return WeatherKeys(named > 0, region_days, days * (ROW_BYTES + code))


def _complete(weather: DataFrame) -> DataFrame:
    return ensure_columns(weather, [T.StructField("region", T.StringType()), *WEATHER_METRICS])


def attach_weather(
    df: DataFrame,
    weather: DataFrame | None,
    by_region: bool | None = None,
    look: WeatherKeys | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Add the weather of each row's region and ``txn_date``.

    With no weather at all the five columns are typed NULLs. ``by_region=None``
    takes the region into account if any weather row names one, else the date
    alone. What is attached is broadcast if it takes ``broadcast_bytes`` (by
    default ``BROADCAST_BYTES``) at most; beyond that the join shuffles, where
    adaptive execution splits a region-day that holds too many rows. A ``look``
    taken before saves the action that finds both out.
    """
    if weather is None:
        return ensure_columns(df, WEATHER_METRICS)

    look = look_at(weather) if look is None else look
    weather = _complete(weather)
    by_region = look.named if by_region is None else by_region
    keys = {"region": "region", "txn_date": "weather_date"} if by_region else {"txn_date": "weather_date"}

    daily = _one_row_per_key(weather, list(keys.values()))
    most = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if (look.region_day_bytes if by_region else look.day_bytes) <= most:
        daily = F.broadcast(daily)
    left, right = df.drop(*METRIC_NAMES).alias("t"), daily.alias("w")
    condition = [F.col(f"t.{k}") == F.col(f"w.{w}") for k, w in keys.items()]
    return left.join(right, condition, "left").select(
        "t.*", *[F.col(f"w.{metric}") for metric in METRIC_NAMES]
    )


def _one_row_per_key(weather: DataFrame, keys: list[str]) -> DataFrame:
    """Guard against several weather rows per key multiplying sales lines."""
    return weather.groupBy(*keys).agg(
        *[
            (F.min if metric == CODE else F.avg)(
                F.col(metric).cast(WEATHER_METRICS[metric].dataType)
            ).alias(metric)
            for metric in METRIC_NAMES
        ]
    )
