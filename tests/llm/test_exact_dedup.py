"""Exact duplicates against brute force, with hashes that collide and hot groups."""
import collections
import hashlib

import pytest
from pyspark.sql import functions as F

from mercaflow.llm import exact_dedup
from mercaflow.llm.exact_dedup import exact_duplicates, without_copies
from tests.llm.helpers import SCHEMA, documents, texts_of


def expected(texts, largest):
    groups = collections.defaultdict(list)
    for i, text in texts.items():
        groups[text or ""].append(i)
    out = {}
    for text, ids in groups.items():
        keep = max(ids) if largest else min(ids)
        for i in ids:
            out[i] = (keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest())
    return out


def found(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


def short_hash(text):
    """Four values only, so that most texts collide."""
    return F.unhex(F.conv(F.substring(F.md5(text), 1, 1), 16, 4))


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("hashed", [exact_dedup.content_hash, short_hash])
def test_groups_of_equal_texts(spark, keep, hashed):
    docs = documents(spark)
    marked = exact_duplicates(docs, keep, hashed=hashed)
    assert marked.columns == [*docs.columns, "keep_id", "group_size", "kept", "text_sha256"]
    assert found(marked) == expected(texts_of(docs), keep == "largest")
    assert {r.doc_id: r.text for r in marked.collect()} == texts_of(docs)


def test_most_rows_are_one_text(spark):
    rows = [(i, "hot" if i % 3 else f"t{i // 6}" + "x" * (i % 2)) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marked = exact_duplicates(docs)
    assert found(marked) == expected(dict(rows), False)
    assert without_copies(docs).count() == len({t for _, t in rows})


def test_normalised_texts(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a  B"), (3, "ab"), (4, None)], "doc_id long, text string")
    one_space = lambda text: F.lower(F.regexp_replace(text, " +", " "))
    assert found(exact_duplicates(docs, normalise=one_space))[2][:3] == (1, 2, False)
    assert sorted(r.doc_id for r in without_copies(docs, normalise=one_space).collect()) == [1, 3, 4]


def test_repeated_rows_ids_that_are_null_and_clashing_columns(spark):
    rows = [(5, "same", 1), (5, "same", 2), (6, "same", 3), (None, "same", 4), (None, "alone", 5), (None, "alone", 6), (7, "x" * 300_000, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept long")
    marked = exact_duplicates(docs)
    assert marked.columns == ["doc_id", "text", "keep_id", "group_size", "kept", "text_sha256"]
    got = collections.Counter((r.doc_id, r.text[:5], r.keep_id, r.group_size, r.kept) for r in marked.collect())
    assert got == {
        (5, "same", 5, 4, True): 2,
        (6, "same", 5, 4, False): 1,
        (None, "same", 5, 4, False): 1,
        (None, "alone", None, 2, True): 2,
        (7, "xxxxx", 7, 1, True): 1,
    }
    left = without_copies(docs)
    assert left.columns == docs.columns
    assert collections.Counter((r.doc_id, r.text[:5]) for r in left.collect()) == {
        (5, "same"): 1, (None, "alone"): 1, (7, "xxxxx"): 1
    }


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert exact_duplicates(nothing).count() == 0 and without_copies(nothing).columns == nothing.columns


def test_no_python_in_the_plan(spark, capsys):
    exact_duplicates(documents(spark)).explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan or "BroadcastHashJoin" in plan
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
