"""The daily sales fact with its channel and payment mixes."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercaflow.functions.columns import ensure_columns
from mercaflow.functions.stats import money_parts, total_of_parts
from mercaflow.operators.weather import METRIC_NAMES, WeatherKeys, attach_weather
from mercaflow.schemas import WEATHER_METRICS

FACT_KEYS = ["txn_date", "region", "store_id", "category"]
UNKNOWN = "unknown"
# Lines of a folder with more than its share of them are dealt by this too.
PART = "_part"
CODE = "weather_code"


def fact_sales_daily(
    df: DataFrame,
    weather: DataFrame | None = None,
    exact: bool = True,
    look: WeatherKeys | None = None,
    broadcast_bytes: int | None = None,
    partitions: int | None = None,
    folders: Sequence[str] = (),
) -> DataFrame:
    """Daily sales per region, store and category.

    Weather is the same for every line of a fact row, so a weather table given
    here is attached after the aggregation, to the far smaller fact. Without
    one, weather columns already on the lines are averaged. ``look`` and
    ``broadcast_bytes`` are those of ``attach_weather``. ``partitions`` is the
    number of tasks that lines are dealt to, once: they sort them, and spill what
    does not fit. Without it lines travel twice, to as many as Spark decides.
    ``folders``, some of the fact's keys, has lines dealt by these, so that the
    rows of a folder can be written where they are made: they are in one task, or
    in several where the folder has more lines than a task's share.
    """
    on_lines = [m for m in METRIC_NAMES if m in df.columns] if weather is None else []
    keys, deal = FACT_KEYS, FACT_KEYS
    if partitions and folders:
        keys, deal = [*FACT_KEYS, PART], [*folders, PART]
        df = _parted(df, folders, partitions)
    fact = _with_mixes(_fact_details(df, on_lines, exact, partitions, keys, deal), on_lines, exact, keys)
    if weather is None:
        fact = ensure_columns(fact, WEATHER_METRICS)
    else:
        fact = attach_weather(fact, weather, look=look, broadcast_bytes=broadcast_bytes)
    return fact.select(
        *FACT_KEYS,
        "orders",
        "items_sold",
        "revenue",
        "unique_customers",
        *METRIC_NAMES,
        _ticket().alias("avg_ticket"),
        "channel_mix",
        "payment_mix",
    )


def _ticket() -> Column:
    """Revenue per order; 0 where there is no order, NULL without revenue."""
    return F.when(F.col("orders") > 0, F.col("revenue") / F.col("orders")).otherwise(0.0)


def _parted(df: DataFrame, folders: Sequence[str], partitions: int) -> DataFrame:
    """``df`` with the part of its folder that each line is in, which follows from
    its fact key. Fewer folders than ``partitions`` have more lines than a share,
    so their table is small."""
    share = max(1, df.count() // partitions)
    sizes = df.groupBy(*folders).agg(F.ceil(F.count(F.lit(1)) / share).alias("_parts")).filter("_parts > 1")
    sizes = sizes.withColumnsRenamed({c: f"_{c}" for c in folders})
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in folders))
    part = F.pmod(F.xxhash64(*FACT_KEYS), F.coalesce("_parts", F.lit(1)))
    return df.join(F.broadcast(sizes), same, "left").withColumn(PART, part).select(*df.columns, PART)


def _fact_details(
    df: DataFrame, on_lines: list[str], exact: bool, partitions: int | None, keys: Sequence[str], deal: Sequence[str]
) -> DataFrame:
    """Everything a fact row is made of, one row per fact key, channel and payment
    method, with the orders and customers counted in it (exact) or in its fact row.

    Lines are dealt by ``deal``, to ``partitions`` tasks, and no line is expanded.
    An order or a customer of a fact row counts in the first of its lines only;
    NULL keys group together here, which equality joins of separate aggregates
    would lose.
    """
    lines = df.select(
        *keys,
        "txn_id",
        "customer_id",
        F.coalesce("channel", F.lit(UNKNOWN)).alias("channel"),
        F.coalesce("payment_method", F.lit(UNKNOWN)).alias("payment_method"),
        "revenue",
        "quantity",
        *on_lines,
    )
    mix = ["channel", "payment_method"]
    if CODE in on_lines:
        # As a key it keeps the aggregation on hashes; a minimum of text would sort all lines.
        mix.append(CODE)
    counted = {"orders": "txn_id", "unique_customers": "customer_id"}
    whole, fraction = money_parts("revenue")
    sums = [
        whole.alias("revenue_whole"),
        fraction.alias("revenue_fraction"),
        F.sum("quantity").alias("items_sold"),
        *_weather_parts(on_lines),
    ]
    number = [partitions] if partitions else []
    if exact:
        if not number:
            # In tasks of unknown size each of the two sorts has a stage of its own.
            lines = lines.repartition(*keys, "txn_id").withColumn("orders", _first_of("txn_id", keys)).drop("txn_id")
        lines = lines.repartition(*number, *deal)
        lines = lines.withColumns({n: _first_of(c, keys) for n, c in counted.items() if n not in lines.columns})
        counts = [F.sum(name).alias(name) for name in counted]
    else:
        row = Window.partitionBy(*keys)
        sketched = {name: F.approx_count_distinct(column).over(row) for name, column in counted.items()}
        lines = lines.repartition(*number, *deal).withColumns(sketched)
        counts = [F.max(name).alias(name) for name in counted]
    details = lines.groupBy(*keys, *mix).agg(*counts, *sums)
    revenue = total_of_parts(F.col("revenue_whole"), F.col("revenue_fraction"))
    return details.withColumn("revenue", revenue)


def _first_of(column: str, keys: Sequence[str]) -> Column:
    """1 in one line of each known value of ``column`` in a fact row, else 0."""
    value = F.col(column)
    number = F.row_number().over(Window.partitionBy(*keys, column).orderBy(column))
    return F.when(value.isNotNull() & (number == 1), 1).otherwise(0)


def _weather_parts(on_lines: list[str]) -> list[Column]:
    """Mergeable parts of the weather averages."""
    parts = []
    for metric in on_lines:
        if metric != CODE:
            parts += [F.sum(metric).alias(f"{metric}_sum"), F.count(metric).alias(f"{metric}_count")]
    return parts


def _with_mixes(details: DataFrame, on_lines: list[str], exact: bool, keys: Sequence[str]) -> DataFrame:
    """One row per fact key; the collected mix holds one entry per pair of
    channel and payment method, never one per line."""
    counted = F.sum if exact else F.max
    weather = []
    for metric in on_lines:
        if metric == CODE:
            weather.append(F.min(F.col(metric).cast("string")).alias(metric))
        else:
            average = F.try_divide(F.sum(f"{metric}_sum"), F.sum(f"{metric}_count"))
            weather.append(average.alias(metric))
    return (
        details.groupBy(*keys)
        .agg(
            counted("orders").alias("orders"),
            counted("unique_customers").alias("unique_customers"),
            F.sum("items_sold").alias("items_sold"),
            F.sum("revenue").cast("double").alias("revenue"),
            *weather,
            F.collect_list(F.struct("channel", "payment_method", "revenue")).alias("mix"),
        )
        .withColumns({"channel_mix": _mix_map("channel"), "payment_mix": _mix_map("payment_method")})
        .drop("mix")
    )


def _mix_map(dimension: str) -> Column:
    """Map from each value of ``dimension`` to its revenue, keys in order.

    One pass over the sorted entries sums up those of a value. NULL revenue is
    skipped like in ``sum``; a value with nothing else is NULL.
    """
    money = "decimal(28,4)"
    entries = F.array_sort(
        F.transform("mix", lambda e: F.struct(e[dimension].alias("value"), e["revenue"].cast(money).alias("revenue")))
    )
    total = f"struct<value:string,revenue:{money}>"
    nothing = F.struct(F.array().cast(f"array<{total}>").alias("done"), F.lit(None).cast(total).alias("last"))

    def add(seen: Column, entry: Column) -> Column:
        last = seen["last"]
        same = F.coalesce(last["value"] == entry["value"], F.lit(False))
        done = F.when(same | last.isNull(), seen["done"]).otherwise(F.array_append(seen["done"], last))
        summed = F.coalesce((last["revenue"] + entry["revenue"]).cast(money), last["revenue"], entry["revenue"])
        revenue = F.when(same, summed).otherwise(entry["revenue"])
        now = F.struct(entry["value"].alias("value"), revenue.alias("revenue"))
        return F.struct(done.alias("done"), now.alias("last"))

    def all_of(seen: Column) -> Column:
        return F.when(seen["last"].isNull(), seen["done"]).otherwise(F.array_append(seen["done"], seen["last"]))

    totals = F.aggregate(entries, nothing, add, all_of)
    return F.map_from_entries(
        F.transform(totals, lambda t: F.struct(t["value"].alias("key"), t["revenue"].cast("double").alias("value")))
    )
