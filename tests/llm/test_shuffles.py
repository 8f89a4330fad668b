"""What is shuffled, and what stays of it."""
from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from mercaflow.llm import line_dedup
from mercaflow.llm.storage import scratch, stored
from mercaflow.session import setting


def _shuffle_files(spark) -> int:
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return sum(1 for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f)


def test_no_shuffle_file_of_a_stored_table_stays(spark):
    before = _shuffle_files(spark)
    with scratch(spark, "shuffled") as folder:
        counted = stored(spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count(), "counted", folder)
        assert {r["count"] for r in counted.collect()} == {142, 143}
        assert _shuffle_files(spark) <= before


def test_entries_of_lines_are_shuffled_once(spark):
    schema = "print long, first long, bits long, open boolean, n int, prefix array<int>"
    rows = [
        (1, 1, 0, True, 10, [4, 5, 7]),
        (2, 2, 0, True, 10, [4, 5, 7]),
        (3, 3, 0, False, 10, [4, 5, 7]),
        (4, 4, 0, False, 10, [4, 5, 7]),
        (5, 5, 0, True, 10, [1, 2, 3]),
    ]
    with scratch(spark, "entries") as folder, setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        classes = stored(spark.createDataFrame(rows, schema), "classes", folder)
        found = line_dedup._candidates(line_dedup._entries(classes, "open"), 80)
        # Two open classes once, an open one with each closed one, closed ones not with each other.
        assert sorted(tuple(sorted(r)) for r in found.collect()) == [(1, 2), (1, 3), (1, 4), (2, 3), (2, 4)]
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    shuffled = [x for x in plan.split("\n") if "- Exchange hashpartitioning(token" in x]
    assert len(shuffled) == 2  # open and closed entries; 3 or more if a side is shuffled again


def test_signatures_part_long_lines_that_share_rare_tokens(spark):
    """Sets of 120 tokens fill 64 bits, so that any two of them passed for similar."""
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        keys = np.unique(rng.integers(1 << 20, 1 << 62, 120).astype(np.uint64))
        lines = line_dedup._Lines(np.zeros(1), np.zeros(1), keys, np.array([0, len(keys)]))
        rows.append((i, True, 120, *(int(x[0]) for x in lines.signatures()), [1, 2, 3, 4, 5, 6, 7, 8]))
    schema = f"print long, open boolean, n int, {', '.join(f'{c} long' for c in line_dedup.SIGNATURE)}, prefix array<int>"
    entries = line_dedup._entries(spark.createDataFrame(rows, schema), "open")
    fits, _ = line_dedup._fits(80, line_dedup._signature(entries))
    a, b = (entries.select("token", *(F.col(c).alias(f"{c}_{x}") for c in entries.columns if c != "token")) for x in "ab")
    joined = a.join(b, "token").filter("print_a < print_b")
    assert joined.count() == 8 * 40 * 39 // 2
    assert joined.filter(fits).count() < 0.01 * joined.count()
