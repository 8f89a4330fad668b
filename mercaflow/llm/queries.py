"""One query for each operator over its whole table, and their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from mercaflow.llm.centroids import cluster_vectors, with_inertia
from mercaflow.llm.conversation_repair import repair
from mercaflow.llm.damaged_view import damaged
from mercaflow.llm.decontaminate import benchmark_hits
from mercaflow.llm.exact_dedup import exact_duplicates
from mercaflow.llm import language
from mercaflow.llm.line_dedup import dedup_lines
from mercaflow.llm.mixture import mix_sources
from mercaflow.llm.near_dup import near_duplicates
from mercaflow.llm.neighbours import nearest
from mercaflow.llm.ngram_lm import score_corpus
from mercaflow.llm.round_sql import REPAIR_SQL, cluster_sql
from mercaflow.llm.storage import table
from mercaflow.llm.substring_dedup import remove_repeats
from mercaflow.llm.token_counts import token_counts
from mercaflow.llm.tool_calls import link_tool_calls
from mercaflow.llm.tool_view import SCHEMAS, SQL as TOOL_SQL, tool_messages

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["begin"])
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    learns = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    return score_corpus(table(spark, sf_dir, "documents"), learns)


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, threshold=0.8)


def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, documents = mix_sources(table(spark, sf_dir, "documents"))
    taken = mixed.groupBy("doc_id", "row").agg(F.sum("n_words").alias("taken"))
    key = documents["doc_id"].eqNullSafe(taken["doc_id"]) & (documents["row"] == taken["row"])
    return documents.join(taken, key, "left").select(
        documents["doc_id"], "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = language.fit(docs.filter(~held_out).select("text", "lang"))
    predicted = language.predict(docs, model)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_tool_calls(tool_messages(table(spark, sf_dir, "conversations")), SCHEMAS)
    n_errors = F.when(F.col("errors").isNotNull(), F.size("errors"))
    return linked.select("conv_id", "turn", "call_id", "position", "level", "status", n_errors.alias("n_errors"), "record")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed_lines", F.sha2("text", 256).alias("kept_sha256"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


CLUSTERS = {"k": 40, "rounds": 5, "dims": 64, "scale": 256}
CLUSTER_SEED = 2


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.sha2(F.concat(F.lit(f"{CLUSTER_SEED}:"), F.col("vec_id").cast("string")), 256)
    return with_inertia(*cluster_vectors(table(spark, sf_dir, "embeddings"), order, **CLUSTERS))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_duplicates(table(spark, sf_dir, "documents"), keep="largest")
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations)


def queries() -> dict[str, Query]:
    return {
        "op1_decontaminate": op1_decontaminate,
        "op2_lm_score": op2_lm_score,
        "op3_near_dup": op3_near_dup,
        "op4_nearest": op4_nearest,
        "op5_mix_sources": op5_mix_sources,
        "op6_language": op6_language,
        "op7_token_counts": op7_token_counts,
        "op8_tool_calls": op8_tool_calls,
        "op9_line_dedup": op9_line_dedup,
        "op10_substring_dedup": op10_substring_dedup,
        "op11_centroids": op11_centroids,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_conversation_repair": op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_token_counts": r"""
            SELECT doc_id, length(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens
            FROM documents
        """,
        "op8_tool_calls": TOOL_SQL,
        "op11_centroids": cluster_sql(**CLUSTERS, seed=CLUSTER_SEED),
        "op12_exact_dedup": """
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
                SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                    sha256(coalesce(text, '')) AS text_sha256
                FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
            )
        """,
        "op13_conversation_repair": REPAIR_SQL,
    }
