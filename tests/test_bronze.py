import collections
import json
import os
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameReader, functions as F, types as T

from mercaflow.operators.quality import corrupt_records, quality_report, readable_records
from mercaflow.plans.bronze import ingest
from mercaflow.sources.ledger import new_files, record_files
from mercaflow.sources.tables import read_bronze
from mercaflow.sources.feeds import (
    add_metadata_columns,
    list_files,
    merged_schema,
    read_files,
    read_first_available,
    read_json_source,
    read_parquet_source,
    try_read,
)

DAY = "2025-10-11"
OWNED = {"ingestion_date": DAY, "source": "s"}


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")
    return str(folder / name)


def test_json_source_adds_metadata(spark, tmp_path):
    path = write(tmp_path / "raw" / f"ingestion_date={DAY}", "sample.json", json.dumps({"transaction_id": "A1", "value": 10}))
    df = read_json_source(spark, path, "patagonia", DAY)
    row = df.first()
    assert (row.transaction_id, row.value) == ("A1", 10)
    assert (row.source, row.ingestion_date) == ("patagonia", DAY)
    assert "sample.json" in row.file_name and row.load_ts is not None


def test_json_array_and_json_lines(spark, tmp_path):
    array = write(tmp_path / "a", "array.json", '[{"id": "1"},\n {"id": "2"}]')
    lines = write(tmp_path / "b", "lines.json", '{"id": "1"}\n{"id": "2"}\n{"id": "3"}\n')
    assert read_json_source(spark, array, "s", DAY).count() == 2
    assert read_json_source(spark, lines, "s", DAY, multiline=False).count() == 3


def test_given_schema_is_used(spark, tmp_path):
    path = write(tmp_path, "one.json", '{"id": 7, "qty": "3"}')
    df = read_json_source(spark, path, "s", DAY, schema="id string, qty int, other string")
    assert df.select("id", "other").first() == ("7", None)


def test_corrupt_document_is_set_apart(spark, tmp_path):
    write(tmp_path, "good.json", '{"id": "1", "qty": 2}')
    write(tmp_path, "bad.json", '{"id": "2", "qty": ')
    raw = read_json_source(spark, str(tmp_path / "*.json"), "s", DAY)
    assert [r.id for r in readable_records(raw).collect()] == ["1"]
    bad = corrupt_records(raw).collect()
    assert len(bad) == 1 and bad[0]._corrupt_record == '{"id": "2", "qty": ' and "bad.json" in bad[0].file_name


def test_only_corrupt_documents(spark, tmp_path):
    path = write(tmp_path, "bad.json", '{"id": ')
    raw = read_json_source(spark, path, "s", DAY)
    assert readable_records(raw).isEmpty()
    assert corrupt_records(raw).first()._corrupt_record == '{"id": '


def test_empty_file_has_no_rows(spark, tmp_path):
    path = write(tmp_path, "empty.json", "")
    assert read_json_source(spark, path, "s", DAY).isEmpty()


def test_parquet_source_and_metadata_of_any_frame(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    row = read_parquet_source(spark, str(tmp_path / "p"), "w", DAY).first()
    assert row.source == "w" and row.file_name.endswith(".parquet")
    assert add_metadata_columns(spark.range(1).withColumn("x", F.lit(1)), "s", DAY).first().file_name == ""


def test_try_read_only_swallows_missing_paths(spark, tmp_path):
    assert try_read(lambda: spark.read.parquet(str(tmp_path / "nowhere"))) is None
    with pytest.raises(AnalysisException):
        try_read(lambda: spark.range(1).select("no_such_column"))


def test_fallback_order(spark, tmp_path):
    folder = tmp_path / "w"
    write(folder, "w.json", '{"time": "2025-10-11", "avg_temp": 3.5}')
    readers = [
        lambda: read_parquet_source(spark, f"{folder}/*.parquet", "w", DAY),
        lambda: read_json_source(spark, f"{folder}/*", "w", DAY),
    ]
    assert read_first_available(readers).first().avg_temp == 3.5
    assert read_first_available(readers[:1]) is None


def test_fallback_when_a_file_is_not_parquet(spark, tmp_path):
    write(tmp_path / "w", "w.parquet", '{"time": "2025-10-11", "avg_temp": 3.5}')
    folder = tmp_path / "w"
    readers = [
        lambda: read_parquet_source(spark, f"{folder}/*.parquet", "w", DAY),
        lambda: read_json_source(spark, f"{folder}/*", "w", DAY),
    ]
    assert read_first_available(readers).first().avg_temp == 3.5


def test_quality_report_counts_nulls_of_existing_columns(spark):
    df = spark.createDataFrame([("1", None), (None, None)], "txn_id string, id string")
    row = quality_report(df, ["txn_id", "transaction_id", "id"]).first()
    assert row.asDict() == {"records": 2, "null_txn_id": 1, "null_id": 2}


def test_ingest_writes_both_kinds_and_returns_metrics(spark, tmp_path):
    write(tmp_path / "raw", "x.json", '{"id": "1"}\n{"id": null}\n{"id": \n')
    raw = read_json_source(spark, str(tmp_path / "raw"), "s", DAY, multiline=False)
    counts = ingest(raw, str(tmp_path / "bronze"), str(tmp_path / "bad"), OWNED, ["id", "txn_id"])
    assert (counts["records"], counts["corrupt"]) == (3, 1)
    good = spark.read.parquet(str(tmp_path / "bronze"))
    assert good.count() == 2 and good.filter("_corrupt_record is not null").isEmpty()
    assert "_corrupt_record" not in read_bronze(spark, str(tmp_path / "bronze"), DAY).columns
    assert spark.read.parquet(str(tmp_path / "bad")).first()._corrupt_record.startswith('{"id":')
    assert os.path.isdir(tmp_path / "bronze" / f"ingestion_date={DAY}" / "source=s")


@pytest.mark.parametrize("schema", [None, "id string"])
def test_several_documents_in_a_multiline_file_are_all_read(spark, tmp_path, schema):
    write(tmp_path, "lines.json", '{"id": "1"}\n{"id": "2"}\n{"id": \n')
    write(tmp_path, "array.json", '[{"id": "3"},\n {"id": "4"}]')
    write(tmp_path, "one.json", '{"id":\n "5"}\n')
    write(tmp_path, "blank.json", " \n\n")
    raw = read_json_source(spark, str(tmp_path), "s", DAY, schema)
    assert sorted(r.id for r in readable_records(raw).collect()) == ["1", "2", "3", "4", "5"]
    assert [r._corrupt_record for r in corrupt_records(raw).collect()] == ['{"id": ']
    assert raw.filter("file_name is null").isEmpty()


@pytest.mark.parametrize("schema", [None, "id string"])
def test_nothing_behind_a_document_is_lost(spark, tmp_path, schema):
    files = {
        "same_line.json": '{"id": "1"}\n{"id": "2"} {"id": "3"}\n',
        "one_line.json": '{"id": "4"} {"id": "5"}',
        "pretty.json": '{\n  "id": "6"\n}\n{\n  "id": "7"\n}\n',
        "closed.json": '{"id": "8"}] {"id": "9"}',
    }
    for name, text in files.items():
        write(tmp_path, name, text)
    write(tmp_path, "large.json", json.dumps({"id": "10", "pad": ["x" * 1000] * 20_000}))
    write(tmp_path, "large_pretty.json", json.dumps({"id": "11", "pad": ["x" * 1000] * 20_000}, indent=1))
    write(tmp_path, "lines.json", '{"id": "12"}\n{"id": "13"}\nnonsense\n')
    raw = read_json_source(spark, str(tmp_path), "s", DAY, schema)
    assert sorted(int(r.id) for r in readable_records(raw).select("id").collect()) == list(range(1, 14))
    assert sorted(r._corrupt_record for r in corrupt_records(raw).collect()) == ["]", "nonsense"]


@pytest.mark.parametrize("schema", [None, "id string"])
def test_files_of_every_form(spark, tmp_path, schema):
    files = {
        "bom_lines.json": '\ufeff{"id": "1"}\n{"id": "2"}\n',
        "bom_pretty.json": '\ufeff{"id":\n"3"}\n{"id":\n"4"}',
        "scalar_first.json": '5\n{"id": "5"}\n{"id":\n"6"}',
        "arrays.json": '[{"id": "7"},\n{"id": "8"}]\n[{"id": "9"}]',
        "bad_first.json": 'oops\n{"id": "10", "t": "a } \\" ] {"}\n{"id": "11"}\n',
        "unfinished.json": '{"id": "12"} {"id": "13"}\n{"id": "14",\n "rest": [1,\n',
        # Spark's own inference takes brackets in a file's name for a pattern.
        ("one line [1].json" if schema else "one line.json"): '  {"id": "15"}  ',
        "carriage.json": '{"id": "16"}\r\n{"id": "17"}\r{"id": "18"}',
        "deep.json": '{"id": "19", "d": ' + "[" * 60 + "]" * 60 + '} {"id": "20"}',
        "empty_array.json": "[]",
    }
    for name, text in files.items():
        write(tmp_path, name, text)
    raw = read_json_source(spark, str(tmp_path), "s", DAY, schema)
    good = readable_records(raw).select("id", "file_name").collect()
    assert sorted(int(r.id) for r in good) == [*range(1, 14), *range(15, 21)]
    bad = {r._corrupt_record for r in corrupt_records(raw).collect()}
    assert bad == {"5", "oops", '{"id": "14",\n "rest": [1,'}
    names = {int(r.id): r.file_name.rsplit("/", 1)[1] for r in good}
    assert (names[4], names[15], names[20]) == ("bom_pretty.json", "one%20line%20%5B1%5D.json" if schema else "one%20line.json", "deep.json")


def random_value(rng, depth=0):
    kind = rng.randrange(6 if depth < 4 else 3)
    if kind < 3:
        return rng.choice([1, -2.5, True, None, "", 'q"}{', "a\\", "[x]", "ü\u2028\n"])
    if kind == 3:
        return [random_value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice("abc{"): random_value(rng, depth + 1) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_borders_of_random_files(spark, tmp_path, block):
    """Files are cut into blocks far smaller than their documents, too."""
    rng = random.Random(block)
    expected = collections.Counter()
    for name in range(25):
        text = ""
        for i in range(rng.randrange(1, 9)):
            document = {"id": f"{name}-{i}", "v": random_value(rng)}
            expected[document["id"]] += 1
            dumped = json.dumps(document, indent=rng.choice([None, None, 1]), ensure_ascii=rng.random() < 0.5)
            text += rng.choice(["", " ", "\n"]) + dumped + rng.choice(["\n", "\n\n", " ", ""])
        write(tmp_path, f"{name}.json", text)
    settings = {"spark.sql.files.maxPartitionBytes": block, "spark.sql.files.openCostInBytes": 0}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        raw = read_json_source(spark, str(tmp_path), "s", DAY, "id string").persist()
        assert collections.Counter(r.id for r in raw.collect()) == expected
        assert corrupt_records(raw).isEmpty()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_feed_is_scanned_once_and_parsed_once(spark, tmp_path, monkeypatch):
    for i in range(3):
        write(tmp_path, f"{i}.json", f'{{"id": "{i}"}}\n{{"id":\n"x"}}')
    read = []
    for name in ("text", "json"):
        original = getattr(DataFrameReader, name)
        monkeypatch.setattr(
            DataFrameReader, name, lambda self, where, *a, original=original, name=name: read.append(name) or original(self, where, *a)
        )
    raw = read_json_source(spark, str(tmp_path), "s", DAY, "id string")
    assert raw.count() == 6 and raw.filter("id = 'x'").count() == 3
    # The scan, and the text that is cut; what was cut is stored.
    assert read == ["text", "text"]


def test_a_corrected_file_leaves_no_quarantine(spark, tmp_path):
    bronze, bad = str(tmp_path / "bronze"), str(tmp_path / "bad")
    for text, corrupt in (('{"id": "1"}\n{"id": \n', 1), ('{"id": "1"}\n{"id": "2"}\n', 0)):
        write(tmp_path / "raw", "x.json", text)
        raw = read_json_source(spark, str(tmp_path / "raw"), "s", DAY, multiline=False)
        counts = ingest(raw, bronze, bad, OWNED)
        assert counts["corrupt"] == corrupt
        assert os.path.isdir(f"{bad}/ingestion_date={DAY}/source=s") == bool(corrupt)
    assert sorted(r.id for r in spark.read.parquet(bronze).collect()) == ["1", "2"]


def counted(df, seen):
    """``df``, with ``seen`` raised by each row that is computed."""

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema)


def test_records_are_parsed_once_whatever_their_kind(spark, tmp_path):
    write(tmp_path / "raw", "x.json", '{"id": "1"}\n{"id": "2"}\n{"id": \n')
    raw = read_json_source(spark, str(tmp_path / "raw"), "s", DAY, multiline=False)
    seen = spark.sparkContext.accumulator(0)
    counts = ingest(counted(raw, seen), str(tmp_path / "bronze"), str(tmp_path / "bad"), OWNED)
    assert (counts["records"], counts["corrupt"], seen.value) == (3, 1, 3)
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    assert sorted(os.listdir(tmp_path / "bronze")) == [f"ingestion_date={DAY}"]


def test_a_failed_ingestion_leaves_both_tables_as_they_were(spark, tmp_path):
    bronze, bad = str(tmp_path / "bronze"), str(tmp_path / "bad")
    write(tmp_path / "raw", "x.json", '{"id": "1"}\n{"id": \n')
    raw = read_json_source(spark, str(tmp_path / "raw"), "s", DAY, multiline=False)
    ingest(raw, bronze, bad, OWNED)
    broken = raw.withColumn("id", F.when(F.col("id") == "1", F.raise_error(F.lit("midway"))).otherwise("x"))
    with pytest.raises(Exception, match="midway"):
        ingest(broken, bronze, bad, OWNED)
    assert [r.id for r in spark.read.parquet(bronze).collect()] == ["1"]
    assert spark.read.parquet(bad).count() == 1 and os.listdir(bronze) == [f"ingestion_date={DAY}"]


def test_a_folder_of_both_formats_yields_both(spark, tmp_path):
    folder = tmp_path / "w"
    spark.sql("select 'R1' region, timestamp'2025-10-11 08:00:00' time, 3 avg_temp").write.parquet(str(folder))
    write(folder, "a.json", '{"region": "R2", "time": "2025-10-11 09:00:00", "avg_temp": 3.5}\n{"region": "R3"}')
    write(folder, "named.parquet", '{"region": "R4", "extra": "x"}')
    write(folder, "bad.json", '{"region": ')
    files = [row.file for row in list_files(spark, f"{folder}/*").collect()]
    rows = {r.region: r for r in read_files(spark, files, "w", DAY).collect()}
    assert set(rows) == {"R1", "R2", "R3", "R4", None}
    assert (rows["R1"].time, rows["R1"].avg_temp) == ("2025-10-11 08:00:00", 3.0)
    assert (rows["R2"].time, rows["R2"].avg_temp) == ("2025-10-11 09:00:00", 3.5)
    assert rows["R4"].extra == "x" and rows["R4"].file_name.endswith("named.parquet")
    assert rows[None]._corrupt_record == '{"region": '


def test_a_type_that_holds_both():
    a, b = (T.StructType.fromDDL(x) for x in ("x int, y array<int>, z struct<p: int>, t timestamp", "x double, y array<string>, z struct<q: int>, t string"))
    assert merged_schema(a, b) == T.StructType.fromDDL("x double, y array<string>, z struct<p: int, q: int>, t string")
    assert merged_schema(a, a) == a


def test_a_ledger_lists_what_earlier_dates_have_taken(spark, tmp_path):
    raw, ledger = tmp_path / "raw", str(tmp_path / "ledger")

    def new(day):
        files = new_files(spark, list_files(spark, f"{raw}/*"), ledger, day).collect()
        return files, sorted(f.file.rsplit("/", 1)[1] for f in files)

    write(raw, "a.json", "{}")
    first, names = new("2025-10-10")
    assert names == ["a.json"]
    record_files(spark, first, ledger, "2025-10-10")
    assert new("2025-10-10")[1] == ["a.json"] and new("2025-10-11")[1] == []
    write(raw, "b.json", "{}")
    write(raw, "a.json", '{"changed": 1}')
    assert new("2025-10-11")[1] == ["a.json", "b.json"]
