"""The retail model over the supplied star schema.

Left joins to the dimensions keep every line item. A view joins only the
dimensions that the requested columns come from; Spark cannot drop an outer
join by itself, because it does not know the dimension keys to be unique.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SALES_COLUMNS = [
    "txn_id",
    "txn_date",
    "store_id",
    "region",
    "product_id",
    "product_name",
    "category",
    "quantity",
    "unit_price",
    "revenue",
    "customer_id",
    "channel",
    "payment_method",
    "unit_cost",
]

# Dimension -> (key that refers to it, key of the dimension, dimension that holds
# the referring key; None: the lines). Parts come first: lines then travel to the
# orders with few columns of parts, not to the parts with all of orders.
DIMENSIONS = {
    "part": ("l_partkey", "p_partkey", None),
    "orders": ("l_orderkey", "o_orderkey", None),
    "customer": ("o_custkey", "c_custkey", "orders"),
    "nation": ("c_nationkey", "n_nationkey", "customer"),
    "region": ("n_regionkey", "r_regionkey", "nation"),
}
COLUMN_SOURCE = {
    "txn_date": "orders",
    "customer_id": "orders",
    "channel": "orders",
    "region": "region",
    "product_name": "part",
    "category": "part",
    "unit_cost": "part",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _expressions() -> dict[str, Column]:
    return {
        "txn_id": F.col("l_orderkey").cast("string"),
        "txn_date": F.col("o_orderdate").cast("date"),
        "store_id": F.col("l_suppkey").cast("string"),
        "region": F.col("r_name"),
        "product_id": F.col("l_partkey").cast("string"),
        "product_name": F.col("p_name"),
        "category": F.col("p_type"),
        "quantity": F.col("l_quantity").cast("int"),
        "unit_price": F.try_divide("l_extendedprice", "l_quantity"),
        "revenue": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "customer_id": F.col("o_custkey").cast("string"),
        "channel": F.col("o_orderpriority"),
        "payment_method": F.col("l_returnflag"),
        "unit_cost": F.when(F.col("p_size") % 3 != 0, 0.6 * F.col("p_retailprice")),
        "l_linenumber": F.col("l_linenumber"),
        "l_linestatus": F.col("l_linestatus"),
    }


def _without_some(expressions: dict[str, Column]) -> dict[str, Column]:
    """The same lines with NULLs in grouping columns."""
    nulls = {
        "channel": F.col("l_linenumber") == 7,
        "payment_method": F.col("l_linenumber") == 6,
        "txn_date": F.col("l_linenumber") == 5,
        "customer_id": F.col("o_custkey") % 50 == 0,
        "region": F.col("n_nationkey") == 24,
        "category": F.col("p_size") == 50,
    }
    return {
        name: F.when(~nulls[name], expr) if name in nulls else expr
        for name, expr in expressions.items()
    }


def sales(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] = tuple(SALES_COLUMNS),
    dirty: bool = False,
) -> DataFrame:
    """Sales lines in the engine's names, one per line item."""
    expressions = _without_some(_expressions()) if dirty else _expressions()
    needed: list[str] = []

    def need(dimension: str | None) -> None:
        if dimension and dimension not in needed:
            need(DIMENSIONS[dimension][2])
            needed.append(dimension)

    for column in columns:
        need(COLUMN_SOURCE.get(column))

    def joined(df: DataFrame, parent: str | None) -> DataFrame:
        """``df`` with the dimensions it refers to, each with its own: what hangs
        on orders is joined to these, so that lines travel once for all of it."""
        for dimension in sorted(needed, key=list(DIMENSIONS).index):
            left_key, right_key, referring = DIMENSIONS[dimension]
            if referring == parent:
                right = joined(table(spark, sf_dir, dimension), dimension)
                df = df.join(right, df[left_key] == right[right_key], "left")
        return df

    return joined(table(spark, sf_dir, "lineitem"), None).select(*[expressions[c].alias(c) for c in columns])


def english_feed(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Lines as raw records with English names, text values, two names for the
    transaction id, and some values that cannot be parsed."""
    df = _feed_lines(spark, sf_dir, status)
    line = F.col("l_linenumber")
    return df.select(
        F.when(line != 1, F.col("txn_id")).alias("transaction_id"),
        F.col("txn_id").alias("id"),
        F.when(line == 7, "not a time")
        .otherwise(F.concat(F.col("txn_date").cast("string"), F.lit("T10:30:00")))
        .alias("transaction_ts"),
        "store_id",
        F.col("region").alias("Region"),
        "product_id",
        "product_name",
        "category",
        F.when(line == 6, "x")
        .when(line == 5, F.concat(F.col("quantity").cast("string"), F.lit(".0")))
        .otherwise(F.col("quantity").cast("string"))
        .alias("quantity"),
        "unit_price",
        F.when(line != 2, F.col("revenue")).alias("amount"),
        "customer_id",
        "channel",
        "payment_method",
        "unit_cost",
    )


def spanish_feed(spark: SparkSession, sf_dir: str, status: str | None = None) -> DataFrame:
    """Lines as raw records with Spanish names; revenue is not supplied."""
    return _feed_lines(spark, sf_dir, status).select(
        F.col("txn_id").alias("id_transaccion"),
        F.concat(F.col("txn_date").cast("string"), F.lit(" 18:00:00")).alias("datetime"),
        F.col("store_id").alias("tienda_id"),
        F.col("region").alias("zona"),
        F.col("product_id").alias("sku"),
        F.col("product_name").alias("item_name"),
        F.col("category").alias("categoria"),
        F.col("quantity").alias("cantidad"),
        F.col("unit_price").alias("precio"),
        F.col("customer_id").alias("cliente_id"),
        F.col("channel").alias("canal"),
        F.col("payment_method").alias("metodo_pago"),
    )


def _feed_lines(spark: SparkSession, sf_dir: str, status: str | None) -> DataFrame:
    df = sales(spark, sf_dir, (*SALES_COLUMNS, "l_linenumber", "l_linestatus"))
    return df if status is None else df.filter(F.col("l_linestatus") == status)


def _weather_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a weather reading: its region from the event id, its day
    among the 600 days from 1995-01-01, its time of day kept."""
    events = table(spark, sf_dir, "events")
    regions = table(spark, sf_dir, "region")
    day = F.date_add(F.lit("1995-01-01").cast("date"), F.expr("cast((event_id div 5) % 600 as int)"))
    return events.join(
        regions, (F.col("event_id") % 5).cast("int") == F.col("r_regionkey"), "left"
    ).select(
        F.col("r_name").alias("region"),
        day.alias("day"),
        F.date_format("ts", "HH:mm:ss").alias("clock"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        F.col("event_type").alias("code"),
    )


def daily_weather_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scalar reading per event, under daily names."""
    return _weather_events(spark, sf_dir).select(
        "region",
        F.concat_ws(" ", F.col("day").cast("string"), "clock").alias("time"),
        F.col("value").alias("temperature_2m_mean"),
        F.col("k").cast("string").alias("precipitation_sum"),
        F.col("code").alias("weathercode"),
    )


def hourly_weather_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record of parallel arrays per event: three readings twelve hours
    apart, with a short precipitation array and no humidity."""
    hours = [0, 12, 24]
    start = F.concat_ws(" ", F.col("day").cast("string"), "clock").cast("timestamp_ntz")
    times = [(start + F.expr(f"interval '{h}' hour")).cast("string") for h in hours]
    nothing = F.lit(None).cast("double")
    return _weather_events(spark, sf_dir).select(
        F.col("region").alias("city"),
        F.array(*times).alias("time"),
        F.array(F.col("value"), F.col("value") / 2, -F.col("value")).alias("temperature_2m"),
        F.array(F.col("k"), F.lit(0.0)).alias("precipitation"),
        F.array(F.col("value") * 2, nothing, F.col("k")).alias("wind_speed_10m"),
        F.array(F.col("code"), F.lit("calm"), F.lit("night")).alias("weathercode"),
    )
