"""The registered queries in ANSI SQL, for a comparison on the same tables.

Money is summed as exact decimals here, so the comparison also shows that the
engine's rounded double sums lose nothing.
"""
from __future__ import annotations

_SALES = """
SELECT CAST(l_orderkey AS VARCHAR) AS txn_id,
       {txn_date} AS txn_date,
       CAST(l_suppkey AS VARCHAR) AS store_id,
       {region} AS region,
       CAST(l_partkey AS VARCHAR) AS product_id,
       p_name AS product_name,
       {category} AS category,
       CAST(l_quantity AS INTEGER) AS quantity,
       l_extendedprice / l_quantity AS unit_price,
       l_extendedprice * (1 - l_discount) AS revenue,
       CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS money,
       {customer_id} AS customer_id,
       {channel} AS channel,
       {payment_method} AS payment_method,
       CASE WHEN p_size % 3 <> 0 THEN 0.6 * p_retailprice END AS unit_cost,
       l_linenumber, l_linestatus
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN part ON l_partkey = p_partkey
"""
_CLEAN = {
    "txn_date": "CAST(o_orderdate AS DATE)",
    "region": "r_name",
    "category": "p_type",
    "customer_id": "CAST(o_custkey AS VARCHAR)",
    "channel": "o_orderpriority",
    "payment_method": "l_returnflag",
}
_NULLS = {
    "txn_date": "l_linenumber = 5",
    "region": "n_nationkey = 24",
    "category": "p_size = 50",
    "customer_id": "o_custkey % 50 = 0",
    "channel": "l_linenumber = 7",
    "payment_method": "l_linenumber = 6",
}
SALES = _SALES.format(**_CLEAN)
DIRTY_SALES = _SALES.format(
    **{c: f"CASE WHEN NOT ({_NULLS[c]}) THEN {expr} END" for c, expr in _CLEAN.items()}
)
YEARLY_SALES = SALES.replace(
    "CAST(o_custkey AS VARCHAR) AS customer_id",
    "CONCAT(CAST(o_custkey AS VARCHAR), '-', CAST(YEAR(o_orderdate) AS VARCHAR)) AS customer_id",
)

_READINGS = """
SELECT r_name AS region,
       CAST(DATE '1995-01-01' + CAST((event_id // 5) % 600 AS INTEGER) AS DATE) AS day,
       strftime(ts, '%H:%M:%S') AS clock,
       value,
       CAST(json_extract(props, '$.k') AS DOUBLE) AS k,
       event_type AS code
FROM events LEFT JOIN region ON event_id % 5 = r_regionkey
"""
_DAILY_WEATHER = f"""
SELECT region, day AS weather_date,
       AVG(value) AS weather_avg_temp, AVG(k) AS weather_precipitation,
       FIRST(code ORDER BY clock, code) AS weather_code,
       CAST(NULL AS DOUBLE) AS weather_wind_speed, CAST(NULL AS DOUBLE) AS weather_humidity
FROM ({_READINGS}) GROUP BY region, day
"""

_ROUNDED_WEATHER = """
       ROUND(weather_avg_temp, 6) AS weather_avg_temp,
       ROUND(weather_precipitation, 6) AS weather_precipitation,
       weather_code, weather_wind_speed, weather_humidity"""
_NO_WEATHER = """
       CAST(NULL AS DOUBLE) AS weather_avg_temp, CAST(NULL AS DOUBLE) AS weather_precipitation,
       CAST(NULL AS VARCHAR) AS weather_code, CAST(NULL AS DOUBLE) AS weather_wind_speed,
       CAST(NULL AS DOUBLE) AS weather_humidity"""


def _money(expression: str = "money") -> str:
    return f"ROUND(CAST(SUM({expression}) AS DOUBLE), 4)"


def _pearson(x: str, y: str) -> str:
    value = f"CORR({x}, {y})"
    return f"ROUND(CASE WHEN isfinite({value}) THEN {value} END, 6)"


def top_products(sales: str) -> str:
    return f"""
WITH daily AS (
  SELECT category, product_id, product_name, txn_date,
         {_money()} AS daily_revenue, CAST(SUM(quantity) AS BIGINT) AS daily_quantity
  FROM ({sales}) GROUP BY ALL),
ranked AS (
  SELECT *,
         ROW_NUMBER() OVER (PARTITION BY category, txn_date
           ORDER BY daily_revenue DESC NULLS LAST, product_id NULLS FIRST, product_name NULLS FIRST) AS rank,
         LAG(daily_revenue) OVER (PARTITION BY category, product_id
           ORDER BY txn_date NULLS FIRST, product_name NULLS FIRST) AS previous
  FROM daily)
SELECT category, product_id, product_name, txn_date, daily_revenue, daily_quantity,
       CAST(rank AS INTEGER) AS rank,
       (daily_revenue - previous) / NULLIF(previous, 0) AS revenue_change_pct
FROM ranked WHERE rank <= 10"""


def customer_frequency(sales: str) -> str:
    return f"""
SELECT CAST(date_trunc('month', txn_date) AS DATE) AS txn_month, customer_id, region,
       COUNT(DISTINCT txn_id) AS transaction_count,
       {_money()} AS total_revenue,
       {_money()} / COUNT(money) AS avg_ticket,
       CAST(SUM(quantity) AS BIGINT) AS items_purchased
FROM ({sales}) GROUP BY 1, 2, 3"""


def revenue_by_region(sales: str) -> str:
    metrics = f"{_money()}, CAST(SUM(quantity) AS BIGINT), COUNT(DISTINCT txn_id)"
    nothing = "CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT)"
    names = (
        "period_type, period_start, region, weekly_revenue, weekly_quantity, weekly_orders, "
        "monthly_revenue, monthly_quantity, monthly_orders"
    )
    return f"""
WITH periods({names}) AS (
  SELECT 'weekly', CAST(date_trunc('week', txn_date) AS DATE), region, {metrics}, {nothing}
  FROM ({sales}) GROUP BY 2, 3
  UNION ALL
  SELECT 'monthly', CAST(date_trunc('month', txn_date) AS DATE), region, {nothing}, {metrics}
  FROM ({sales}) GROUP BY 2, 3)
SELECT * FROM periods"""


def new_vs_returning(sales: str, distinct: bool = False) -> str:
    lines = "DISTINCT customer_id, txn_month, active_months" if distinct else "customer_id, txn_month, active_months"
    return f"""
WITH monthly AS (
  SELECT customer_id, CAST(date_trunc('month', txn_date) AS DATE) AS txn_month FROM ({sales})),
flags AS (
  SELECT customer_id, COUNT(DISTINCT txn_month) AS active_months FROM monthly GROUP BY customer_id),
joined AS (SELECT {lines} FROM monthly LEFT JOIN flags USING (customer_id))
SELECT txn_month,
       COUNT(CASE WHEN active_months >= 2 THEN 1 END) AS returning_customers,
       COUNT(CASE WHEN active_months < 2 THEN 1 END) AS new_customers,
       COUNT(CASE WHEN active_months >= 2 THEN 1 END) / GREATEST(COUNT(active_months), 1) AS returning_ratio
FROM joined GROUP BY txn_month"""


def price_volume(sales: str) -> str:
    return f"""
SELECT category, {_pearson('unit_price', 'quantity')} AS price_volume_corr,
       ROUND(AVG(unit_price), 6) AS avg_unit_price, AVG(quantity) AS avg_quantity
FROM ({sales}) GROUP BY category"""


def margin(sales: str) -> str:
    cost = "CAST(COALESCE(unit_cost, unit_price * 0.7) * quantity AS DECIMAL(18,6))"
    return f"""
SELECT *, ROUND(total_revenue - total_cost, 4) AS margin FROM (
  SELECT product_id, product_name, category, {_money()} AS total_revenue,
         CAST(SUM(quantity) AS BIGINT) AS items_sold, {_money(cost)} AS total_cost
  FROM ({sales}) GROUP BY product_id, product_name, category)"""


def channel_payment(sales: str) -> str:
    return f"""
SELECT channel, payment_method, region, txn_date, {_money()} AS revenue,
       CAST(SUM(quantity) AS BIGINT) AS items_sold, COUNT(DISTINCT txn_id) AS orders
FROM ({sales}) GROUP BY channel, payment_method, region, txn_date"""


def anomalies(sales: str) -> str:
    return f"""
WITH daily AS (
  SELECT txn_date, region, category, {_money()} AS daily_revenue,
         CAST(SUM(quantity) AS BIGINT) AS daily_quantity
  FROM ({sales}) GROUP BY txn_date, region, category),
stats AS (
  SELECT *,
         ROUND(CAST(SUM(CAST(daily_revenue AS DECIMAL(18,4))) OVER w AS DOUBLE), 4)
           / COUNT(daily_revenue) OVER w AS mean_revenue,
         STDDEV_SAMP(daily_revenue) OVER w AS std_revenue
  FROM daily WINDOW w AS (PARTITION BY region, category)),
scored AS (
  SELECT *, (daily_revenue - mean_revenue) / NULLIF(std_revenue, 0) AS z FROM stats)
SELECT txn_date, region, category, daily_revenue, daily_quantity, mean_revenue,
       ROUND(std_revenue, 4) AS std_revenue, ROUND(z, 6) AS z_score, ABS(z) >= 3 AS is_anomaly
FROM scored"""


def _attached(keys: str, weather: str, columns: str) -> str:
    return f"""
SELECT {columns}, {_ROUNDED_WEATHER}
FROM ({SALES}) t LEFT JOIN ({weather}) w ON {keys}"""


_BY_REGION = "t.region = w.weather_region AND t.txn_date = w.weather_date"
_WEATHER_BY_REGION = f"SELECT region AS weather_region, * EXCLUDE (region) FROM ({_DAILY_WEATHER})"
_WEATHER_BY_DATE = f"""
SELECT weather_date, AVG(weather_avg_temp) AS weather_avg_temp,
       AVG(weather_precipitation) AS weather_precipitation, MIN(weather_code) AS weather_code,
       CAST(NULL AS DOUBLE) AS weather_wind_speed, CAST(NULL AS DOUBLE) AS weather_humidity
FROM ({_DAILY_WEATHER}) GROUP BY weather_date"""
_ATTACH_COLUMNS = "txn_id, product_id, txn_date, t.region AS region, quantity"


def weather_impact(sales: str) -> str:
    return f"""
SELECT region, {_pearson('weather_avg_temp', 'revenue')} AS corr_temp_revenue,
       {_pearson('weather_precipitation', 'revenue')} AS corr_precip_revenue,
       ROUND(AVG(weather_avg_temp), 6) AS avg_temp, ROUND(AVG(weather_precipitation), 6) AS avg_precip
FROM (SELECT t.*, w.* EXCLUDE (weather_region, weather_date)
      FROM ({sales}) t LEFT JOIN ({_WEATHER_BY_REGION}) w ON {_BY_REGION})
GROUP BY region"""


def fact(sales: str, weather: str | None) -> str:
    join = f"LEFT JOIN ({weather}) w ON f.region = w.weather_region AND f.txn_date = w.weather_date" if weather else ""
    metrics = _ROUNDED_WEATHER if weather else _NO_WEATHER
    return f"""
WITH f AS (
  SELECT txn_date, region, store_id, category, COUNT(DISTINCT txn_id) AS orders,
         CAST(SUM(quantity) AS BIGINT) AS items_sold, {_money()} AS revenue,
         COUNT(DISTINCT customer_id) AS unique_customers,
         CAST(COUNT(DISTINCT COALESCE(channel, 'unknown')) AS INTEGER) AS channel_mix,
         CAST(COUNT(DISTINCT COALESCE(payment_method, 'unknown')) AS INTEGER) AS payment_mix
  FROM ({sales}) GROUP BY txn_date, region, store_id, category)
SELECT f.*, {metrics},
       CASE WHEN orders > 0 THEN revenue / orders ELSE 0.0 END AS avg_ticket
FROM f {join}"""


def mix(sales: str, column: str) -> str:
    return f"""
SELECT txn_date, region, store_id, category, COALESCE({column}, 'unknown') AS {column},
       {_money()} AS revenue
FROM ({sales}) GROUP BY ALL"""


_ENGLISH = f"""
SELECT txn_id,
       CASE WHEN l_linenumber <> 7 THEN CONCAT(CAST(txn_date AS VARCHAR), ' 10:30:00') END AS txn_ts,
       store_id, region, product_id, product_name, category,
       CASE WHEN l_linenumber <> 6 THEN quantity END AS quantity, unit_price,
       CASE WHEN l_linenumber <> 2 THEN revenue
            ELSE quantity * unit_price END AS revenue,
       customer_id, channel, payment_method, unit_cost, l_linestatus
FROM ({SALES})"""
_SPANISH = f"""
SELECT txn_id, CONCAT(CAST(txn_date AS VARCHAR), ' 18:00:00') AS txn_ts,
       store_id, region, product_id, product_name, category, quantity, unit_price,
       quantity * unit_price AS revenue,
       customer_id, channel, payment_method, CAST(NULL AS DOUBLE) AS unit_cost, l_linestatus
FROM ({SALES})"""
_FEEDS = f"""
SELECT * EXCLUDE (l_linestatus), 'english' AS source FROM ({_ENGLISH}) WHERE l_linestatus = 'O'
UNION ALL
SELECT * EXCLUDE (l_linestatus), 'spanish' AS source FROM ({_SPANISH}) WHERE l_linestatus = 'F'"""
# The stored feeds as the indicators see them.
_STORED_SALES = f"""
SELECT * EXCLUDE (txn_ts), CAST(CAST(txn_ts AS TIMESTAMP) AS DATE) AS txn_date,
       CAST(revenue AS DECIMAL(18,4)) AS money
FROM ({_FEEDS})"""

_RAW_LINE = """CONCAT('{"transaction_id":"', CAST(l_orderkey AS VARCHAR), '","line":', CAST(l_linenumber AS VARCHAR)"""


# What the gold tables hold in place of a NULL partition value.
_FILLS = {"txn_date": "DATE '1970-01-01'", "region": "'unknown'", "category": "'unknown'"}
RUN_DATE = "2025-10-11"


def _filled(sql: str, *columns: str) -> str:
    """A gold table as stored: its run date, and fills for NULL partitions."""
    fills = ", ".join(f"COALESCE({c}, {_FILLS[c]}) AS {c}" for c in columns)
    return f"SELECT '{RUN_DATE}' AS dt, * {f'REPLACE ({fills})' if fills else ''} FROM ({sql})"


def _close(sql: str, *counts: str) -> str:
    """The exact rows, with the claims that a sketched query makes of itself."""
    flags = ", ".join(f"TRUE AS {c}_close" for c in counts)
    return f"SELECT *, {flags}, TRUE AS rest_equal FROM ({sql})"


def oracle() -> dict[str, str]:
    return {
        "silver_standardize": f"SELECT * EXCLUDE (l_linestatus), 'english' AS source FROM ({_ENGLISH})",
        "silver_union": _FEEDS,
        "decimal_revenue": f"""
            SELECT region, CAST(date_trunc('month', txn_date) AS DATE) AS txn_month,
                   CAST(SUM(money) AS DOUBLE) AS revenue, COUNT(*) AS records
            FROM ({SALES}) GROUP BY 1, 2""",
        "top_products_by_category": top_products(SALES),
        "top_products_by_category_nulls": top_products(DIRTY_SALES),
        "customer_frequency_ticket": customer_frequency(SALES),
        "customer_frequency_ticket_approx": _close(customer_frequency(SALES), "transaction_count"),
        "revenue_by_region": revenue_by_region(SALES),
        "revenue_by_region_approx": _close(revenue_by_region(SALES), "weekly_orders", "monthly_orders"),
        "revenue_by_region_nulls": revenue_by_region(DIRTY_SALES),
        "new_vs_returning": new_vs_returning(SALES),
        "new_vs_returning_nulls": new_vs_returning(DIRTY_SALES),
        "new_vs_returning_yearly": new_vs_returning(YEARLY_SALES),
        "new_vs_returning_customers": new_vs_returning(SALES, distinct=True),
        "new_vs_returning_customers_yearly": new_vs_returning(YEARLY_SALES, distinct=True),
        "price_volume_corr": price_volume(SALES),
        "margin_by_product": margin(SALES),
        "channel_payment_perf": channel_payment(SALES),
        "channel_payment_perf_approx": _close(channel_payment(SALES), "orders"),
        "channel_payment_perf_nulls": channel_payment(DIRTY_SALES),
        "anomalies": anomalies(SALES),
        "anomalies_nulls": anomalies(DIRTY_SALES),
        "weather_hourly": f"""
            WITH hours AS (
              SELECT region, CAST(CONCAT(CAST(day AS VARCHAR), ' ', clock) AS TIMESTAMP) AS start, value, k, code
              FROM ({_READINGS})),
            readings AS (
              SELECT region, start AS ts, value AS temp, k AS precip, value * 2 AS wind, code FROM hours
              UNION ALL
              SELECT region, start + INTERVAL 12 HOUR, value / 2, 0.0, NULL, 'calm' FROM hours
              UNION ALL
              SELECT region, start + INTERVAL 24 HOUR, -value, NULL, k, 'night' FROM hours)
            SELECT region, CAST(ts AS DATE) AS weather_date,
                   ROUND(AVG(temp), 6) AS weather_avg_temp, ROUND(AVG(precip), 6) AS weather_precipitation,
                   FIRST(code ORDER BY ts, code) AS weather_code,
                   ROUND(AVG(wind), 6) AS weather_wind_speed, CAST(NULL AS DOUBLE) AS weather_humidity
            FROM readings GROUP BY region, CAST(ts AS DATE)""",
        "weather_daily": f"SELECT region, weather_date, {_ROUNDED_WEATHER} FROM ({_DAILY_WEATHER})",
        "weather_no_metrics": f"SELECT DISTINCT region, day AS weather_date, {_NO_WEATHER} FROM ({_READINGS})",
        "attach_weather": _attached(_BY_REGION, _WEATHER_BY_REGION, _ATTACH_COLUMNS),
        "attach_weather_by_date": _attached(
            "t.txn_date = w.weather_date", _WEATHER_BY_DATE, _ATTACH_COLUMNS
        ),
        "attach_weather_missing": f"SELECT {_ATTACH_COLUMNS}, {_NO_WEATHER} FROM ({SALES}) t",
        "weather_impact": weather_impact(SALES),
        "fact_sales_daily": fact(SALES, _WEATHER_BY_REGION),
        "fact_sales_daily_approx": _close(fact(SALES, _WEATHER_BY_REGION), "orders", "unique_customers"),
        "fact_sales_daily_nulls": fact(DIRTY_SALES, None),
        "channel_mix": mix(SALES, "channel"),
        "channel_mix_nulls": mix(DIRTY_SALES, "channel"),
        "payment_mix": mix(SALES, "payment_method"),
        "payment_mix_nulls": mix(DIRTY_SALES, "payment_method"),
        "partition_fill": f"""
            SELECT '2025-10-11' AS dt, txn_id, product_id, store_id, channel,
                   COALESCE(txn_date, DATE '1970-01-01') AS txn_date,
                   COALESCE(region, 'unknown') AS region, COALESCE(category, 'unknown') AS category
            FROM ({DIRTY_SALES})""",
        "quality_metrics": f"""
            SELECT COUNT(*) AS records,
                   COUNT(*) - COUNT(txn_id) AS null_txn_id,
                   COUNT(*) - COUNT(customer_id) AS null_customer_id,
                   COUNT(*) - COUNT(region) AS null_region,
                   COUNT(*) - COUNT(channel) AS null_channel
            FROM ({DIRTY_SALES})""",
        "bronze_metadata": """
            SELECT o_orderkey, o_custkey, o_totalprice, 'orders' AS source,
                   '2025-10-11' AS ingestion_date, 'orders.parquet' AS file_name, TRUE AS has_load_ts
            FROM orders""",
        "bronze_json_roundtrip": """
            SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag,
                   'lineitem' AS source, '2025-10-11' AS ingestion_date, 'json' AS file_type
            FROM lineitem""",
        "bronze_quarantine": f"""
            SELECT CASE WHEN l_linenumber = 7 THEN {_RAW_LINE}) END AS raw_text,
                   CASE WHEN l_linenumber <> 7 THEN CAST(l_orderkey AS VARCHAR) END AS transaction_id,
                   CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS BIGINT) END AS line,
                   l_linenumber = 7 AS quarantined
            FROM lineitem""",
        "medallion_silver": f"""
            SELECT txn_id, txn_ts, store_id, region, product_id, product_name, category, quantity,
                   unit_price, revenue, customer_id, channel, payment_method, unit_cost, source
            FROM ({_FEEDS})""",
        "medallion_revenue_by_region": revenue_by_region(_STORED_SALES),
        "medallion_margin_by_product": margin(_STORED_SALES),
        "medallion_price_volume_corr": price_volume(_STORED_SALES),
        "medallion_weather_daily": f"SELECT region, weather_date, {_ROUNDED_WEATHER} FROM ({_DAILY_WEATHER})",
        "medallion_weather_impact": weather_impact(_STORED_SALES),
        "medallion_top_products_by_category": _filled(top_products(_STORED_SALES), "txn_date", "category"),
        "medallion_customer_frequency_ticket": _filled(customer_frequency(_STORED_SALES)),
        "medallion_new_vs_returning": _filled(new_vs_returning(_STORED_SALES)),
        "medallion_channel_payment_perf": _filled(channel_payment(_STORED_SALES), "txn_date", "region"),
        "medallion_anomalies": _filled(anomalies(_STORED_SALES), "txn_date", "region"),
        "medallion_fact_sales_daily": _filled(
            fact(_STORED_SALES, _WEATHER_BY_REGION), "txn_date", "region", "category"
        ),
        "medallion_rerun": f"""
            SELECT '{RUN_DATE}' AS dt, * FROM ({customer_frequency(f"SELECT * FROM ({_STORED_SALES}) WHERE source = 'spanish'")})""",
        "revenue_by_region_merged": _close(revenue_by_region(SALES), "weekly_orders", "monthly_orders"),
        "history_top_products_by_category": top_products(SALES),
        "history_margin_by_product": margin(SALES),
        "history_anomalies": anomalies(SALES),
        "history_weather_impact": weather_impact(SALES),
        "history_new_vs_returning": new_vs_returning(SALES),
        "bronze_mixed_formats": f"""
            SELECT region, day, COUNT(*) AS readings, TRUE AS one_format
            FROM ({_READINGS}) GROUP BY region, day""",
        "medallion_weather_ledger": f"""
            SELECT region, weather_date, {_ROUNDED_WEATHER}, (SELECT COUNT(*) FROM events) AS readings_taken
            FROM ({_DAILY_WEATHER})""",
        "bronze_json_multiline": """
            SELECT o_orderkey, o_custkey, o_orderstatus, 'orders' AS source FROM orders""",
    }
