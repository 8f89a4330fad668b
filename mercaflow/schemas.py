"""Names and types of the data model."""
from __future__ import annotations

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"

# Accepted source names of each transaction column, in order of
# preference when a feed carries more than one of them.
TRANSACTION_ALIASES: dict[str, tuple[str, ...]] = {
    "txn_id": ("transaction_id", "txn_id", "id_transaccion", "id"),
    "txn_ts": ("transaction_ts", "txn_ts", "datetime", "txn_date", "date", "timestamp", "fecha"),
    "store_id": ("store_id", "tienda_id", "shop_id", "sucursal_id"),
    "region": ("zona", "region"),
    "product_id": ("product_id", "sku", "id_producto", "producto_id"),
    "product_name": ("product_name", "item", "item_name"),
    "category": ("category", "categoria"),
    "quantity": ("quantity", "qty", "cantidad"),
    "unit_price": ("unit_price", "price", "precio"),
    "revenue": ("revenue", "amount", "importe_total"),
    "customer_id": ("customer_id", "client_id", "id_cliente", "cliente_id"),
    "channel": ("channel", "canal"),
    "payment_method": ("payment_method", "metodo_pago"),
    "load_ts": ("load_ts",),
    "unit_cost": ("unit_cost",),
    "source": ("source",),
    "ingestion_date": ("ingestion_date",),
}

TRANSACTIONS = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("txn_ts", T.TimestampType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("region", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("load_ts", T.TimestampType()),
        T.StructField("unit_cost", T.DoubleType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingestion_date", T.StringType()),
    ]
)

# Column names of the stored silver table (left: engine name).
SILVER_NAMES: dict[str, str] = {
    "txn_id": "id",
    "txn_ts": "fecha",
    "store_id": "sucursal_id",
    "product_id": "producto_id",
    "product_name": "item_name",
    "category": "categoria",
    "quantity": "cantidad",
    "unit_price": "precio",
    "customer_id": "cliente_id",
    "channel": "canal",
    "payment_method": "metodo_pago",
}

WEATHER_METRICS = T.StructType(
    [
        T.StructField("weather_avg_temp", T.DoubleType()),
        T.StructField("weather_precipitation", T.DoubleType()),
        T.StructField("weather_code", T.StringType()),
        T.StructField("weather_wind_speed", T.DoubleType()),
        T.StructField("weather_humidity", T.DoubleType()),
    ]
)

# Accepted source names of the weather feed, in order of preference.
WEATHER_REGION_NAMES = ("region", "city", "name", "location")
WEATHER_TIME_NAMES = ("time", "timestamp", "datetime", "date")
HOURLY_NAMES: dict[str, tuple[str, ...]] = {
    "weather_avg_temp": ("temperature_2m",),
    "weather_precipitation": ("precipitation",),
    "weather_wind_speed": ("wind_speed_10m",),
    "weather_humidity": ("relative_humidity_2m",),
    "weather_code": ("weathercode",),
}
DAILY_NAMES: dict[str, tuple[str, ...]] = {
    "weather_avg_temp": ("temperature_2m_mean", "temperature_mean", "temp_mean", "avg_temp"),
    "weather_precipitation": ("precipitation", "precipitation_sum", "precip"),
    "weather_code": ("weathercode", "weather_code", "condition_code"),
}
