"""Mergeable daily aggregates, and the indicators that derive from them.

Every measure can be added up further: counts, integer sums of money, moments,
and sketches of distinct counts. An indicator over many days, or over the run
dates of a history, merges stored aggregates in place of its lines.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from mercaflow.functions.stats import MONEY_SCALE, money_of_parts, money_parts
from mercaflow.operators import kpis

PRODUCT_DAY = ["txn_date", "region", "category", "product_id", "product_name"]
REGION_DAY = ["txn_date", "region"]


def _parts(name: str, column, scale: int = MONEY_SCALE) -> list:
    whole, fraction = money_parts(column, scale)
    return [whole.alias(f"{name}_whole"), fraction.alias(f"{name}_fraction")]


def product_days(df: DataFrame, cost_factor: float = kpis.DEFAULT_COST_FACTOR) -> DataFrame:
    """Sales of each product, day and region: revenue, cost, quantity, and the
    moments of line revenue."""
    return df.groupBy(*PRODUCT_DAY).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("revenue").alias("n"),
        F.avg("revenue").alias("mean"),
        F.var_pop("revenue").alias("variance"),
        F.sum("quantity").alias("quantity"),
        *_parts("revenue", "revenue"),
        *_parts("cost", kpis.line_cost(cost_factor), kpis.COST_SCALE),
    )


def top_products(days: DataFrame) -> DataFrame:
    daily = days.groupBy("category", "product_id", "product_name", "txn_date").agg(
        money_of_parts("revenue").alias("daily_revenue"), F.sum("quantity").alias("daily_quantity")
    )
    return kpis.top_products_of_days(daily)


def margin(days: DataFrame) -> DataFrame:
    totals = days.groupBy("product_id", "product_name", "category").agg(
        money_of_parts("revenue").alias("total_revenue"),
        F.sum("quantity").alias("items_sold"),
        money_of_parts("cost", kpis.COST_SCALE).alias("total_cost"),
    )
    return kpis.with_margin(totals)


def anomalies(days: DataFrame) -> DataFrame:
    daily = days.groupBy("txn_date", "region", "category").agg(
        money_of_parts("revenue").alias("daily_revenue"), F.sum("quantity").alias("daily_quantity")
    )
    return kpis.anomalies_of_days(daily)


def region_days(days: DataFrame) -> DataFrame:
    """``kpis.region_days`` from ``product_days``. Variances are merged about the
    common mean, so that nothing cancels."""
    day = Window.partitionBy("region", "txn_date")
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(day), F.sum("n").over(day))
    apart = days.withColumn("day_mean", mean)
    gap = F.col("mean") - F.col("day_mean")
    squares = F.sum(F.col("n") * (F.col("variance") + gap * gap))
    return apart.groupBy("region", "txn_date").agg(
        F.sum("lines").alias("lines"),
        F.sum("n").alias("n"),
        F.max("day_mean").alias("mean"),
        F.try_divide(squares, F.sum("n")).alias("variance"),
    )


def customer_months(df: DataFrame) -> DataFrame:
    return kpis.customer_months(df)


def new_vs_returning(months: DataFrame) -> DataFrame:
    """From the ``customer_months`` of several run dates: a month or a customer
    may be in more than one."""
    merged = months.groupBy("customer_id", "txn_month").agg(F.sum("lines").alias("lines"))
    return kpis.new_vs_returning_of_months(merged)


def region_day_sketches(df: DataFrame) -> DataFrame:
    """Sales of each region and day with sketches of their orders and customers."""
    return df.groupBy(*REGION_DAY).agg(
        *_parts("revenue", "revenue"),
        F.sum("quantity").alias("quantity"),
        F.hll_sketch_agg("txn_id").alias("orders"),
        F.hll_sketch_agg("customer_id").alias("customers"),
    )


def revenue_by_region(days: DataFrame) -> DataFrame:
    """Weeks and months of each region from ``region_day_sketches``: the sketches
    of their days are merged, no line is read again."""
    week, month, region = F.col("week"), F.col("month"), F.col("region")
    totals = (
        days.withColumns({"week": kpis.week(), "month": kpis.month()})
        .groupingSets([[week, region], [month, region]], week, month, region)
        .agg(
            (F.grouping("month") == 1).alias("weekly"),
            money_of_parts("revenue").alias("revenue"),
            F.sum("quantity").alias("quantity"),
            F.hll_sketch_estimate(F.hll_union_agg("orders")).alias("orders"),
        )
    )
    return kpis.periods(totals)
