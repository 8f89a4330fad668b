from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from mercaflow.functions.columns import decimal_column, ensure_columns, first_existing_column
from mercaflow.operators.transactions import (
    standardize_transactions,
    to_gold_names,
    to_silver_names,
    union_feeds,
)
from mercaflow.schemas import TRANSACTIONS

ENGLISH = (
    "transaction_id string, transaction_ts string, store_id string, region string, product_id string, "
    "product_name string, category string, quantity bigint, unit_price double, customer_id string, "
    "channel string, payment_method string"
)
SPANISH = (
    "id string, datetime string, tienda_id string, zona string, sku string, item_name string, "
    "categoria string, cantidad bigint, precio double, cliente_id string, canal string, metodo_pago string"
)


def feeds(spark):
    english = spark.createDataFrame(
        [("E-77", "2024-03-05T07:45:10", "shop-4", "North", "P-31", "Kettle", "Kitchen", 3, 12.5, "cust-8", "web", "wallet")],
        ENGLISH,
    )
    spanish = spark.createDataFrame(
        [("S-15", "2024-03-06 21:05:00", "shop-6", "South", "P-90", "Lantern", "Outdoor", 4, 7.25, "cust-3", "kiosk", "cash")],
        SPANISH,
    )
    return english, spanish


def test_both_vocabularies_become_one_schema(spark):
    english, spanish = (standardize_transactions(df) for df in feeds(spark))
    assert english.columns == spanish.columns == TRANSACTIONS.fieldNames()
    assert [f.dataType for f in english.schema] == [f.dataType for f in TRANSACTIONS]
    rows = {r.txn_id: r for r in english.unionByName(spanish).collect()}
    assert rows["E-77"].revenue == 37.5 and rows["S-15"].revenue == 29.0
    assert (rows["S-15"].region, rows["S-15"].payment_method) == ("South", "cash")
    assert rows["E-77"].txn_ts == datetime(2024, 3, 5, 7, 45, 10)
    assert rows["S-15"].txn_ts == datetime(2024, 3, 6, 21, 5)


def test_union_skips_absent_feeds(spark):
    english, spanish = feeds(spark)
    assert union_feeds([english, spanish]).count() == 2
    assert union_feeds([None, spanish]).count() == 1
    assert union_feeds([None, None]) is None


def test_malformed_values_become_null(spark):
    df = spark.createDataFrame(
        [("1", "2.0", "9.5", "2025-10-11"), ("2", "x", "y", "never"), ("3", "7", "1e1", "2025-10-11 01:02:03")],
        "id string, qty string, price string, date string",
    )
    rows = {r.txn_id: r for r in standardize_transactions(df).collect()}
    assert [rows[i].quantity for i in "123"] == [2, None, 7]
    assert [rows[i].unit_price for i in "123"] == [9.5, None, 10.0]
    assert rows["2"].txn_ts is None and rows["2"].revenue is None
    assert rows["1"].revenue == 19.0


def test_several_aliases_of_one_column_are_coalesced_in_order(spark):
    df = spark.createDataFrame(
        [("t", "i", 5.0, 6.0), (None, "i", None, 6.0)],
        "id string, transaction_id string, amount double, revenue double",
    ).select(F.col("id"), F.col("transaction_id"), "amount", "revenue")
    rows = standardize_transactions(df).collect()
    assert {r.txn_id for r in rows} == {"i"}
    assert {r.revenue for r in rows} == {6.0}


def test_names_match_in_any_case_and_extra_columns_are_dropped(spark):
    df = spark.createDataFrame([("A", "S1", "x")], "`Transaction_ID` string, `STORE_ID` string, `a.b` string")
    out = standardize_transactions(df)
    assert out.columns == TRANSACTIONS.fieldNames()
    assert out.select("txn_id", "store_id").first() == ("A", "S1")


def test_unit_cost_and_provenance_are_carried(spark):
    df = spark.createDataFrame([("A", 4.5, "f", "2025-10-11")], "id string, unit_cost double, source string, ingestion_date string")
    row = standardize_transactions(df).first()
    assert (row.unit_cost, row.source, row.ingestion_date) == (4.5, "f", "2025-10-11")


def test_stored_names_and_back(spark):
    standard = standardize_transactions(feeds(spark)[0])
    stored = to_silver_names(standard)
    assert stored.columns[:14] == [
        "id", "fecha", "sucursal_id", "region", "producto_id", "item_name", "categoria", "cantidad",
        "precio", "revenue", "cliente_id", "canal", "metodo_pago", "load_ts",
    ]
    gold = to_gold_names(stored)
    assert set(TRANSACTIONS.fieldNames()) | {"txn_date"} == set(gold.columns)
    assert gold.first().txn_date == date(2024, 3, 5)


def test_gold_names_leave_present_names_and_add_a_missing_cost(spark):
    df = spark.createDataFrame([("A", "B", 3.0)], "id string, txn_id string, precio double")
    row = to_gold_names(df).first()
    assert (row.txn_id, row.id, row.unit_price, row.unit_cost) == ("B", "A", 3.0, None)


def test_column_helpers(spark):
    df = spark.createDataFrame([("12.345", "x")], "a string, b string")
    assert first_existing_column(df, ["z", "b", "a"]) == "b"
    assert first_existing_column(df, ["z"]) is None
    assert ensure_columns(df, TRANSACTIONS.fields[7:9]).dtypes[-2:] == [("quantity", "int"), ("unit_price", "double")]
    row = df.select(decimal_column(F.col("a")).alias("a"), decimal_column(F.col("b")).alias("b")).first()
    assert (row.a, row.b) == (Decimal("12.35"), None)
