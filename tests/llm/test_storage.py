"""Which intermediate tables stay behind."""
import glob

from mercaflow.llm.line_dedup import dedup_lines
from mercaflow.llm.near_dup import near_duplicates
from mercaflow.llm.storage import scratch, stored


def folders(spark):
    return set(glob.glob(spark.conf.get("spark.checkpoint.dir") + "/*"))


def names(paths):
    return {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in paths}


def test_tables_of_a_block_go_with_it(spark):
    before = folders(spark)
    with scratch(spark, "block") as folder:
        inner = stored(spark.range(3), "inner", folder)
        outer = stored(inner.filter("id > 0"), "outer")
    assert names(folders(spark) - before) == {"outer"}
    assert sorted(r.id for r in outer.collect()) == [1, 2]


def test_only_what_the_result_reads_stays(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text + "\nsecond line here"), (2, text + " more\nsecond line here"), (3, "other"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = folders(spark)
    got = dedup_lines(docs)
    assert names(folders(spark) - before) == {"gone_lines"}
    assert {r.doc_id: r.n_removed_lines for r in got.collect()} == {1: 0, 2: 2, 3: 0, 4: 0}
    before = folders(spark)
    found = near_duplicates(docs, 2)
    assert not names(folders(spark) - before) & {"nodes", "step", "central", "pairs", "sets", "trees"}
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
