"""Operators against plain Python on random lines: NULLs everywhere, and one
key of each column on a third of the lines."""
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

from mercaflow.operators import kpis
from mercaflow.operators.fact import fact_sales_daily
from tests.fixtures import SALES_SCHEMA

COLUMNS = [c.split()[0] for c in SALES_SCHEMA.split(", ")]


def random_lines(seed, count=400):
    rng = random.Random(seed)

    def pick(hot, others, nulls=0.1):
        if rng.random() < nulls:
            return None
        return hot if rng.random() < 1 / 3 else rng.choice(others)

    days = [date(2025, 1, 1) + timedelta(days=9 * i) for i in range(12)]
    return [
        (
            pick("T0", [f"T{i}" for i in range(90)]),
            pick(days[0], days),
            pick("R0", ["R1", "R2"]),
            pick("S0", ["S1"]),
            pick("C0", [f"C{i}" for i in range(60)]),
            pick("P0", [f"P{i}" for i in range(15)]),
            pick("N0", ["N1"]),
            pick("K0", ["K1"]),
            pick("online", ["shop", "phone"]),
            pick(1, [2, 3]),
            pick(10.0, [4.0, 2.5]),
            pick(20.0, [1.25, 7.5, 0.0]),
            pick("card", ["cash"]),
            pick(3.0, [1.0], nulls=0.5),
        )
        for _ in range(count)
    ]


@pytest.fixture(scope="module", params=[1, 2])
def lines(request, spark):
    rows = random_lines(request.param)
    return [dict(zip(COLUMNS, r)) for r in rows], spark.createDataFrame(rows, SALES_SCHEMA)


def grouped(rows, *keys):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row)
    return groups


def total(rows, column):
    values = [r[column] for r in rows if r[column] is not None]
    return sum(values) if values else None


def distinct(rows, column):
    return len({r[column] for r in rows} - {None})


def month(day):
    return day and day.replace(day=1)


def test_fact(lines):
    rows, df = lines
    expected = {}
    for key, group in grouped(rows, "txn_date", "region", "store_id", "category").items():
        mixes = []
        for dimension in ("channel", "payment_method"):
            parts = grouped([{**r, dimension: r[dimension] or "unknown"} for r in group], dimension)
            mixes.append({k[0]: total(g, "revenue") for k, g in parts.items()})
        orders, revenue = distinct(group, "txn_id"), total(group, "revenue")
        ticket = 0.0 if orders == 0 else None if revenue is None else revenue / orders
        expected[key] = (
            orders, total(group, "quantity"), revenue, distinct(group, "customer_id"), ticket, *mixes
        )
    actual = {
        tuple(r[:4]): (
            r.orders, r.items_sold, r.revenue, r.unique_customers, r.avg_ticket, r.channel_mix, r.payment_mix
        )
        for r in fact_sales_daily(df).collect()
    }
    assert actual == expected


@pytest.mark.parametrize("distinct_customers", [False, True])
def test_new_vs_returning(lines, distinct_customers):
    rows, df = lines
    rows = [{**r, "month": month(r["txn_date"])} for r in rows]
    active = {k: distinct(g, "month") for (k,), g in grouped(rows, "customer_id").items()}
    expected = {}
    for (start,), group in grouped(rows, "month").items():
        customers = [r["customer_id"] for r in group if r["customer_id"] is not None]
        if distinct_customers:
            customers = set(customers)
        returning = sum(active[c] >= 2 for c in customers)
        expected[start] = (returning, len(customers) - returning)
    kpi = kpis.new_vs_returning_customers if distinct_customers else kpis.new_vs_returning
    actual = {r.txn_month: (r.returning_customers, r.new_customers) for r in kpi(df).collect()}
    assert actual == expected


def test_top_products(lines):
    rows, df = lines
    daily = grouped(rows, "category", "product_id", "product_name", "txn_date")
    revenue = {key: total(group, "revenue") for key, group in daily.items()}
    first = date.min

    def null_first(*values):
        return tuple((v is not None, v if v is not None else "") for v in values)

    previous = {}
    for pair in {k[:2] for k in revenue}:
        keys = [k for k in revenue if k[:2] == pair]
        keys.sort(key=lambda k: (k[3] or first, null_first(k[2])))
        previous.update({k: revenue[before] for before, k in zip(keys, keys[1:])})
    expected = {}
    for pair in {(k[0], k[3]) for k in revenue}:
        keys = [k for k in revenue if (k[0], k[3]) == pair]
        keys.sort(key=lambda k: (revenue[k] is None, -(revenue[k] or 0), null_first(k[1], k[2])))
        for rank, key in enumerate(keys[:10], 1):
            before, now = previous.get(key), revenue[key]
            change = None if not before or now is None else (now - before) / before
            expected[key] = (rank, now, change)
    actual = {
        tuple(r[:4]): (r["rank"], r.daily_revenue, r.revenue_change_pct)
        for r in kpis.top_products_by_category(df).collect()
    }
    assert actual == expected


def test_margin_and_channels(lines):
    rows, df = lines
    expected = {}
    for key, group in grouped(rows, "product_id", "product_name", "category").items():
        costs = [
            {"cost": cost * r["quantity"]}
            for r in group
            if r["quantity"] is not None
            and (cost := r["unit_cost"] if r["unit_cost"] is not None else r["unit_price"] and r["unit_price"] * 0.7)
            is not None
        ]
        revenue, cost = total(group, "revenue"), total(costs, "cost")
        margin = None if revenue is None or cost is None else round(revenue - cost, 4)
        expected[key] = (revenue, total(group, "quantity"), cost and pytest.approx(cost), margin and pytest.approx(margin))
    actual = {tuple(r[:3]): tuple(r[3:]) for r in kpis.margin_by_product(df).collect()}
    assert actual == expected

    keys = ("channel", "payment_method", "region", "txn_date")
    expected = {
        key: (total(g, "revenue"), total(g, "quantity"), distinct(g, "txn_id"))
        for key, g in grouped(rows, *keys).items()
    }
    assert {tuple(r[:4]): tuple(r[4:]) for r in kpis.channel_payment_perf(df).collect()} == expected
