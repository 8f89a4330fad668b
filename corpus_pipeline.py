"""A corpus pipeline of five of the operators: each stage works on what the
stage before kept, and returns the columns of ``documents``; the last one
returns the mix."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from mercaflow.llm import language
from mercaflow.llm.decontaminate import decontaminate
from mercaflow.llm.line_dedup import dedup_lines
from mercaflow.llm.mixture import mix_sources, with_texts
from mercaflow.llm.near_dup import near_duplicates
from mercaflow.llm.storage import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, by a model of the labelled ones."""
    return language.in_known_language(docs, language.fit(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that earlier ones have; those of which
    nothing is left go. ``n_chars`` follows the text where a line went."""
    kept = dedup_lines(docs).filter("n_removed_lines = 0 or text rlike '[^ \\\\t\\\\n\\\\r]'")
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed_lines") > 0, length).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    decided = near_duplicates(docs).groupBy("doc_id").agg(F.bool_or("kept").alias("kept"))
    return docs.join(decided.filter("not kept"), "doc_id", "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: pieces of documents, by output shard and slot."""
    taken, _ = mix_sources(docs)
    return with_texts(taken, docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_dup", one_of_near_copies),
    ("decontaminate", without_benchmark),
    ("mix", mixed),
]

# Language scores, seeds and graph components are beyond SQL; tests/llm check what
# each stage keeps of a small table, and the operators against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
