"""What the jobs move: how often lines travel, what is stored, and what is sorted."""
import datetime
import glob

import pytest

from mercaflow.config import JobConfig
from mercaflow.operators.fact import fact_sales_daily
from mercaflow.plans import bronze, gold
from mercaflow.session import SORT_INPUT_BYTES, sort_partitions
from mercaflow.workload import registry, views
from tests.test_fact import sales

DAY = datetime.datetime(2025, 3, 1)
TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "North")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
    "customer": ("c_custkey long, c_nationkey int", [(1, 0), (1, 0), (2, None)]),
    "part": ("p_partkey long, p_name string, p_type string, p_size int, p_retailprice double", [(1, "p", "t", 3, 2.0)]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
        [(1, 1, DAY, "1"), (2, 2, DAY, None), (3, None, DAY, "2"), (3, 9, DAY, "2")],
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string",
        [(k, 1, 5, n, 2.0, 10.0, 0.5, "R", "OF"[n % 2]) for k in (1, 2, 3, 4, None) for n in range(1, 4)],
    ),
    "events": ("event_id long, ts timestamp, event_type string, value double, props string", [(5, DAY, "c", 1.0, "{}")]),
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimensions_of_orders_are_joined_to_orders_not_to_lines(spark, tables):
    df = views.sales(spark, tables, ["txn_id", "region", "customer_id", "category"])
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter, (l_orderkey") < plan.index("Join LeftOuter, (o_custkey")
    got = sorted((tuple(r) for r in df.collect()), key=str)
    one, two = [("1", "North", "1", "t")] * 6, [("2", None, "2", "t")] * 3
    three = [("3", None, c, "t") for c in (None, "9") for _ in range(3)]
    rest = [(k, None, None, "t") for k in ("4", None) for _ in range(3)]
    assert got == sorted(one + two + three + rest, key=str)


def test_no_line_of_the_fact_is_expanded(spark):
    assert "Expand" not in plan_of(fact_sales_daily(sales(spark), exact=True))


def test_lines_of_the_fact_travel_once_to_tasks_of_bounded_size(spark):
    plan = plan_of(fact_sales_daily(sales(spark), exact=True, partitions=7))
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan


def test_tasks_that_sort_grow_with_the_input(spark, tmp_path):
    (tmp_path / "part").write_bytes(bytes(20 * SORT_INPUT_BYTES + 1))
    assert sort_partitions(spark, [str(tmp_path)]) == 21
    assert sort_partitions(spark, [str(tmp_path / "missing")]) == spark.sparkContext.defaultParallelism


def test_lines_travel_to_parts_before_they_carry_their_order(spark, tables):
    plan = views.sales(spark, tables, ["txn_date", "category"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter, (l_orderkey") < plan.index("Join LeftOuter, (l_partkey")


def test_gold_reads_small_splits(spark, tmp_path, monkeypatch):
    size, seen = "spark.sql.files.maxPartitionBytes", []
    monkeypatch.setattr(gold, "write_table", lambda *args: seen.append(spark.conf.get(size)))
    before = spark.conf.get(size)
    config = JobConfig(str(tmp_path), "2025-01-01", register=False)
    gold.write_gold(spark.range(1), "channel_payment_perf", config)
    assert seen == [gold.READ_BYTES] and spark.conf.get(size) == before


def test_no_sketch_of_the_fact_travels(spark):
    plan = plan_of(fact_sales_daily(sales(spark), exact=False))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Union" not in plan


def test_raw_feeds_of_the_lake_are_compressed(spark, tables):
    config = registry._new_lake(spark, tables)
    files = glob.glob(config.input_bucket.removeprefix("file:") + "/raw/*/ingestion_date=*/part-*")
    assert files and all(f.endswith(".json.gz") for f in files)


def test_lines_of_the_history_are_joined_once(spark, tables, monkeypatch):
    reads = []
    monkeypatch.setattr(registry, "write_table", lambda df, *args, **kwargs: reads.append(df))
    registry._deliveries(spark, tables)
    assert len(reads) == 4 and not any("Join" in plan_of(df) for df in reads[:3])


def test_both_kinds_of_records_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    writers, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    write = bronze.write_folder
    monkeypatch.setattr(bronze, "write_folder", lambda *args: (seen.append(spark.conf.get(writers)), write(*args)))
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "a.json").write_text('{"id": 1}\n{"id": 2\n{"id": 3}\n')
    before = spark.conf.get(writers)
    raw = bronze.read_json_source(spark, str(tmp_path / "raw"), "a", "2025-01-01", multiline=False)
    path, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    bronze.ingest(raw, path, bad, {"source": "a"})
    assert int(seen[0]) >= 2 and spark.conf.get(writers) == before
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 3]
    assert [r["_corrupt_record"] for r in spark.read.parquet(bad).collect()] == ['{"id": 2']
