import pytest

from mercaflow import session as S
from mercaflow.config import JobConfig, parse_config
from mercaflow.plans import bronze, gold, silver
from tests.test_jobs import DAY1, english, put


@pytest.fixture
def kept_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def test_shuffles_are_sized_from_the_input(spark, tmp_path, monkeypatch, kept_partitions):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.bin").write_bytes(b"x" * 1000)
    (tmp_path / "y.bin").write_bytes(b"y" * 500)
    assert S.input_bytes(spark, str(tmp_path)) == 1500
    assert S.input_bytes(spark, str(tmp_path / "nowhere")) == 0
    assert S.size_shuffles(spark, [str(tmp_path)]) == 200
    assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    monkeypatch.setattr(S, "SHUFFLE_INPUT_BYTES", 4)
    assert S.size_shuffles(spark, [str(tmp_path)]) == 375
    assert S.input_bytes(spark, f"{tmp_path}/*") == 1500
    assert S.size_shuffles(spark, [str(tmp_path)], override=7) == 7


def test_the_three_commands(spark, tmp_path, kept_partitions):
    put(tmp_path, "patagonia", DAY1, "a.json", english("A1", DAY1, 2, 10.0))
    arguments = ["--input_bucket", str(tmp_path), "--run_date", DAY1, "--no_register", "--shuffle_partitions", "2"]
    assert [job.main(arguments) for job in (bronze, silver, gold)] == [0, 0, 0]
    assert spark.read.parquet(f"{tmp_path}/gold/marts/fact_sales_daily").count() == 1
    empty = [*arguments[:1], str(tmp_path / "empty"), *arguments[2:]]
    assert [job.main(empty) for job in (bronze, silver, gold)] == [0, 1, 1]


def test_gold_of_a_date_without_rows_writes_no_rows(spark, tmp_path, kept_partitions):
    put(tmp_path, "patagonia", DAY1, "a.json", english("A1", DAY1, 2, 10.0))
    config = JobConfig(str(tmp_path), DAY1, register=False)
    bronze.run_bronze(spark, config)
    silver.run_silver(spark, config)
    later = JobConfig(str(tmp_path), "2030-01-01", register=False)
    assert gold.run_gold(spark, later, ["anomalies"]) == {"anomalies": {"records": 0}}


def test_the_warehouse_takes_the_place_of_an_unset_folder():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.sql.warehouse.dir": "hdfs:/warehouse"}.get(key, default)

    class Session:
        conf = Conf

    assert S.shared_folder(Session, "x").startswith("hdfs:/warehouse/_intermediate/x-")


def test_a_schema_for_each_feed_on_the_command_line():
    base = ["--input_bucket", "b", "--src_patagonia", "shop"]
    config = parse_config("x", [*base, "--schema", "shop=id string, qty int", "--schema", "openmeteo=time string"])
    assert [f.schema for f in config.feeds] == ["id string, qty int", None]
    assert config.weather_schema == "time string"
    with pytest.raises(SystemExit):
        parse_config("x", [*base, "--schema", "nobody=id string"])
