"""The fact as dealt for its folders: the same rows, less on disk."""
import random

import pytest
from pyspark.sql import functions as F

from mercaflow.config import JobConfig
from mercaflow.operators.fact import FACT_KEYS, fact_sales_daily
from mercaflow.operators.transactions import to_silver_names
from mercaflow.plans.gold import run_gold
from mercaflow.sinks.tables import write_table

FOLDERS = ["txn_date", "region"]
SCHEMA = (
    "txn_id string, txn_date date, store_id string, region string, category string, customer_id string, "
    "channel string, payment_method string, quantity int, revenue double"
)


def _lines(spark):
    """Lines of which a third has one day and region, and some have no day or region."""
    rng = random.Random(3)
    rows = []
    for k in range(900):
        day = "2025-01-01" if k % 3 == 0 else rng.choice(["2025-01-02", "2025-01-03", None])
        region = "North" if k % 3 == 0 else rng.choice(["South", None])
        pick = lambda *values: rng.choice(values)
        rows.append((
            str(rng.randrange(300)), day, pick("1", "2", None), region, pick("a", "b", "c", None), pick("x", "y", "z", None),
            pick("web", None), pick("card", "cash"), 1, float(rng.randrange(100)),
        ))
    return spark.createDataFrame(rows, SCHEMA.replace("txn_date date", "txn_date string")).withColumn(
        "txn_date", F.col("txn_date").cast("date")
    )


def _rows(df):
    return sorted((str(r) for r in df.collect()))


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(1 for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f)


@pytest.mark.parametrize("exact", [True, False])
def test_rows_do_not_depend_on_how_lines_are_dealt(spark, exact):
    lines = _lines(spark).cache()
    plain = fact_sales_daily(lines, exact=exact, partitions=6)
    dealt = fact_sales_daily(lines, exact=exact, partitions=6, folders=FOLDERS)
    assert dealt.columns == plain.columns and _rows(dealt) == _rows(plain)
    where = dealt.select(*FOLDERS, F.spark_partition_id().alias("task")).groupBy(*FOLDERS).agg(F.count_distinct("task").alias("n"))
    tasks = {(str(r.txn_date), r.region): r.n for r in where.collect()}
    # 300 of 900 lines are two shares of six; no other folder has more than its own.
    assert tasks.pop(("2025-01-01", "North")) <= 2 and set(tasks.values()) == {1}
    assert len(tasks) == 6


def test_the_fact_is_written_by_the_tasks_that_make_it(spark, tmp_path):
    config = JobConfig(str(tmp_path), "2025-10-11", register=False)
    lines = _lines(spark).withColumn("txn_ts", F.col("txn_date").cast("timestamp")).drop("txn_date")
    lines = lines.withColumns({"unit_price": F.lit(1.0), "product_id": F.lit("p"), "product_name": F.lit("p")})
    silver = to_silver_names(lines)
    write_table(silver, config.silver_path(config.transactions_table), {"run_date": config.run_date}, rebalance=False)
    before = _shuffle_files(spark)
    assert run_gold(spark, config, ["fact_sales_daily"])["fact_sales_daily"]["records"] > 0
    # What was shuffled for the table is gone.
    assert _shuffle_files(spark) <= before
    stored = spark.read.parquet(config.gold_path("fact_sales_daily"))
    fact = fact_sales_daily(_lines(spark), partitions=1)
    filled = fact.fillna({"txn_date": "1970-01-01", "region": "unknown", "category": "unknown"})
    keys = [*FACT_KEYS, "orders", "items_sold", "revenue", "unique_customers"]
    text = [F.coalesce(F.col(c).cast("string"), F.lit("1970-01-01" if c == "txn_date" else "unknown" if c in ("region", "category") else "-")) for c in keys]
    assert _rows(stored.select(*text)) == _rows(filled.select(*text))
