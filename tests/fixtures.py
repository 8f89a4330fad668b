"""Hand-made sales lines and the schema they share."""
from datetime import date, timedelta

SALES_SCHEMA = (
    "txn_id string, txn_date date, region string, store_id string, customer_id string, "
    "product_id string, product_name string, category string, channel string, quantity int, "
    "unit_price double, revenue double, payment_method string, unit_cost double"
)
EARLY, DAY, NEXT = date(2024, 1, 22), date(2024, 3, 14), date(2024, 3, 15)

SALES = [
    ("K1", DAY, "North", "S4", "C7", "P31", "Kettle", "Kitchen", "web", 2, 30.0, 60.0, "card", 18.0),
    ("K6", DAY, "North", "S4", "C8", "P44", "Pan", "Kitchen", "shop", 1, 45.0, 45.0, "cash", None),
    ("K2", EARLY, "North", "S4", "C7", "P31", "Kettle", "Kitchen", "shop", 4, 28.0, 112.0, "cash", 17.0),
    ("K3", DAY, "South", "S5", "C9", "P52", "Lamp", "Living", "web", 3, 25.0, 75.0, "card", 10.0),
    ("K4", NEXT, "North", "S4", "C8", "P31", "Kettle", "Kitchen", "shop", 6, 30.0, 180.0, "cash", None),
    ("K5", NEXT, "North", "S6", "C9", "P44", "Pan", "Kitchen", "web", 2, 45.0, 90.0, "card", 20.0),
    ("K5", NEXT, "North", "S6", "C9", "P31", "Kettle", "Kitchen", "web", 1, 30.0, 30.0, "card", 16.0),
]
LINE = {
    "txn_id": "L1", "txn_date": DAY, "region": "R1", "store_id": "S1", "customer_id": "C1", "product_id": "P1",
    "product_name": "Thing", "category": "Sort", "channel": "online", "quantity": 1, "unit_price": 100.0,
    "revenue": 100.0, "payment_method": "card", "unit_cost": 75.0,
}


def sales(spark, rows=None):
    return spark.createDataFrame(SALES if rows is None else rows, SALES_SCHEMA)


def line(**values):
    """One sales line with defaults for what a test does not care about."""
    return tuple({**LINE, **values}.values())


def days(count, start=date(2025, 1, 1)):
    return [start + timedelta(days=i) for i in range(count)]
