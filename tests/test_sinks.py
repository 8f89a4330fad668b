import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from mercaflow.sinks.catalog import register_table
from mercaflow.sinks import swap
from mercaflow.sinks.tables import clear_owned, fill_partitions, with_dt, write_table
from mercaflow.sources.tables import load_transactions, load_weather, read_partition
from mercaflow.session import shared_folder


def test_a_rerun_replaces_only_its_own_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, rows in (("2025-10-10", 5), ("2025-10-11", 3), ("2025-10-11", 2)):
        assert write_table(spark.range(rows), path, {"run_date": day}) == {"records": rows}
    counts = spark.read.parquet(path).groupBy("run_date").count().collect()
    assert {str(r.run_date): r["count"] for r in counts} == {"2025-10-10": 5, "2025-10-11": 2}


def test_a_rerun_leaves_nothing_of_the_first_run(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select("id", (F.col("id") % 3).alias("region"))
    for day in ("2025-10-10", "2025-10-11"):
        write_table(rows, path, {"dt": day}, ["region"])
    write_table(rows.filter("region = 1"), path, {"dt": "2025-10-11"}, ["region"])
    stored = spark.read.parquet(path)
    assert stored.filter("dt = '2025-10-11'").select("region").distinct().collect() == [(1,)]
    assert stored.filter("dt = '2025-10-10'").count() == 10
    assert write_table(rows.limit(0), path, {"dt": "2025-10-11"}, ["region"]) == {"records": 0}
    assert spark.read.parquet(path).count() == 10


def test_clearing_removes_one_date(spark, tmp_path):
    path = str(tmp_path / "t")
    for day in ("2025-10-10", "2025-10-11"):
        write_table(spark.range(2), path, {"dt": day})
    for _ in range(2):
        clear_owned(spark, path, {"dt": "2025-10-11"})
    assert os.listdir(path) == ["dt=2025-10-10"]


def test_small_partitions_are_gathered_into_one_file(spark, tmp_path):
    df = spark.range(1000).repartition(16)
    write_table(df, str(tmp_path / "t"), {"run_date": "2025-10-10"})
    files = [f for f in os.listdir(tmp_path / "t" / "run_date=2025-10-10") if f.endswith(".parquet")]
    assert len(files) == 1


def test_partition_fill(spark):
    df = spark.createDataFrame([(None, None, None, None)], "txn_date date, region string, category string, channel string")
    row = with_dt(fill_partitions(df), "2025-10-11").first()
    assert row == (date(1970, 1, 1), "unknown", "unknown", None, "2025-10-11")
    assert fill_partitions(spark.range(1)).columns == ["id"]


def test_one_partition_keeps_its_partition_columns(spark, tmp_path):
    root = str(tmp_path / "b")
    for day in ("2025-10-10", "2025-10-11"):
        write_table(spark.range(2), root, {"ingestion_date": day, "source": "s"})
    out = read_partition(spark, root, "ingestion_date", "2025-10-11")
    assert dict(out.dtypes)["ingestion_date"] == "string"
    assert {tuple(r) for r in out.select("ingestion_date", "source").collect()} == {("2025-10-11", "s")}
    assert read_partition(spark, root, "ingestion_date", "2025-01-01") is None


def test_transactions_of_a_date_of_a_range_and_of_all(spark, tmp_path):
    root = str(tmp_path / "transactions")
    for i, day in enumerate(("2025-10-08", "2025-10-10", "2025-10-11")):
        df = spark.range(i + 1).selectExpr("cast(id as string) id", "timestamp'2025-10-01' fecha", "1.5D precio")
        write_table(df, root, {"run_date": day})
    one = load_transactions(spark, root, "2025-10-11")
    assert one.count() == 3 and {"txn_id", "txn_date", "unit_price", "unit_cost"} <= set(one.columns)
    assert load_transactions(spark, root, "2025-10-11", history_days=1).count() == 5
    assert load_transactions(spark, root).count() == 6
    assert load_transactions(spark, root, "2025-12-01").count() == 0
    assert load_transactions(spark, str(tmp_path / "none"), "2025-10-11") is None
    assert load_weather(spark, root, "2025-12-01") is None


def test_table_without_partition_directories_is_filtered(spark, tmp_path):
    path = str(tmp_path / "flat")
    spark.createDataFrame([("a", "2025-10-10"), ("b", "2025-10-11")], "id string, run_date string").write.parquet(path)
    assert [r.txn_id for r in load_transactions(spark, path, "2025-10-11").collect()] == ["b"]


def test_register_and_extend_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(2), path, {"dt": "2025-10-10"})
    assert register_table(spark, "sales_x", path, "shop") is True
    assert spark.table("shop.`sales_x`").count() == 2
    write_table(spark.range(3), path, {"dt": "2025-10-11"})
    assert register_table(spark, "sales_x", path, "shop") is True
    assert spark.table("shop.`sales_x`").count() == 5
    spark.sql("drop database shop cascade")


def test_a_failed_registration_is_reported_not_raised(spark, tmp_path):
    assert register_table(spark, "t", str(tmp_path / "nothing"), "shop2") is False


def test_shared_folder_lies_below_the_configured_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base) and first != second


def test_a_large_table_partition_is_split_into_several_files(spark, tmp_path):
    conf = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "64k")
    try:
        df = spark.range(200_000).withColumn("noise", F.xxhash64("id"))
        df = df.withColumn("region", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id") % 7)))
        assert write_table(df, str(tmp_path / "t"), {}, ["region"]) == {"records": 200_000}
    finally:
        spark.conf.set(conf, before)
    files = [f for f in os.listdir(tmp_path / "t" / "region=hot") if f.endswith(".parquet")]
    assert len(files) > 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 200_000


DAY = {"dt": "2025-10-11"}


@pytest.mark.parametrize("owned", [DAY, {}])
def test_a_write_that_fails_midway_leaves_the_old_rows(spark, tmp_path, owned):
    path = str(tmp_path / "lake" / "t")
    rows = spark.range(100).selectExpr("id", "id % 3 region")
    write_table(rows, path, owned, ["region"])
    write_table(rows, path, {"dt": "2025-10-10"}, ["region"]) if owned else None
    failing = rows.withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("midway"))).otherwise(F.col("id") + 1000))
    with pytest.raises(Exception, match="midway"):
        write_table(failing, path, owned, ["region"])
    stored = spark.read.parquet(path)
    assert stored.count() == (200 if owned else 100) and stored.agg(F.max("id")).first()[0] == 99
    assert not [n for n in os.listdir(tmp_path / "lake") + os.listdir(path) if n in (swap.STAGING, swap.REPLACED)]


def test_the_old_rows_stay_readable_while_the_new_ones_are_written(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "t"), []
    write_table(spark.range(5), path, DAY)

    original = swap._Folders.move

    def move(folders, source, target):
        if not seen:
            seen.append(spark.read.parquet(path).count())
        original(folders, source, target)

    monkeypatch.setattr(swap._Folders, "move", move)
    write_table(spark.range(7), path, DAY)
    # All of the new files were there by the time that the first folder moved.
    assert seen == [5] and spark.read.parquet(path).count() == 7


def test_a_move_that_fails_puts_the_old_rows_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path, DAY)
    original = swap._Folders.move

    def move(folders, source, target):
        if swap.STAGING in source:
            raise swap.SwapFailed(source)
        original(folders, source, target)

    monkeypatch.setattr(swap._Folders, "move", move)
    with pytest.raises(swap.SwapFailed):
        write_table(spark.range(7), path, DAY)
    assert spark.read.parquet(path).count() == 5


@pytest.mark.parametrize("replaced", [False, True])
def test_what_a_dead_job_has_parked_comes_back(spark, tmp_path, replaced):
    """It died after the first move, or after the second."""
    path, other = str(tmp_path / "t"), {"dt": "2025-10-10"}
    for owned in (DAY, other):
        write_table(spark.range(5), path, owned)
    os.makedirs(f"{path}/{swap.REPLACED}")
    os.rename(f"{path}/dt=2025-10-11", f"{path}/{swap.REPLACED}/dt=2025-10-11")
    if replaced:
        os.makedirs(f"{path}/{swap.STAGING}")
        spark.range(7).write.parquet(f"{path}/dt=2025-10-11")
    assert spark.read.parquet(path).count() == (12 if replaced else 5)
    assert swap.recover(spark, path, other) == []
    assert swap.recover(spark, path) == ([] if replaced else ["dt=2025-10-11"])
    assert spark.read.parquet(path).count() == (12 if replaced else 10)
    assert swap.REPLACED not in os.listdir(path)


def test_the_next_write_of_a_date_clears_up_after_a_dead_one(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(5), path, DAY)
    spark.range(100).write.parquet(f"{path}/{swap.STAGING}/dt=2025-10-11")
    os.makedirs(f"{path}/{swap.REPLACED}")
    os.rename(f"{path}/dt=2025-10-11", f"{path}/{swap.REPLACED}/dt=2025-10-11")
    write_table(spark.range(6), path, DAY)
    assert os.listdir(path) == ["dt=2025-10-11"] and spark.read.parquet(path).count() == 6


def test_a_registered_table_follows_what_a_run_has_written(spark, tmp_path):
    path = str(tmp_path / "t")

    def write_day(day, rows):
        write_table(rows, path, {"dt": day}, ["region"])
        assert register_table(spark, "followed", path, "shop3", {"dt": day}) is True

    regions = "case id % 4 when 0 then 'a/b' when 1 then 'it''s' when 2 then null else 'c' end region"
    try:
        write_day("2025-10-10", spark.range(8).selectExpr("id", regions))
        # A folder that no run has written is not taken in with another date's.
        spark.range(3).selectExpr("id").write.parquet(f"{path}/dt=2025-01-01/region=c")
        write_day("2025-10-11", spark.range(8).selectExpr("id", "id * 2 as extra", "named_struct('x', id) deep", regions))
        table = spark.table("shop3.followed")
        assert table.count() == 16 and table.agg(F.sum("extra"), F.max("deep.x")).first() == (56, 7)
        assert table.filter("dt = '2025-10-10'").agg(F.count("extra"), F.count("id")).first() == (0, 8)
        assert {r.region for r in table.select("region").distinct().collect()} == {"a/b", "it's", None, "c"}
        # What the date has no more goes, without a look at the other dates.
        write_day("2025-10-11", spark.range(8).selectExpr("id", "id as extra", regions).filter("region = 'c'"))
        parts = sorted(r[0] for r in spark.sql("show partitions shop3.followed").collect())
        assert len(parts) == 5 and parts[-1] == "dt=2025-10-11/region=c"
        assert spark.table("shop3.followed").count() == 10
        clear_owned(spark, path, {"dt": "2025-10-11"})
        assert register_table(spark, "followed", path, "shop3", {"dt": "2025-10-11"}) is True
        assert spark.table("shop3.followed").count() == 8
    finally:
        spark.sql("drop database if exists shop3 cascade")
