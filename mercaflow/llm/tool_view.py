"""Conversations as tool calls: the supplied table has none of its own.

Every line of a user turn is a call, and waits for the call of the line below it
if its own length is odd; every line of the turn that follows an assistant's is
the result of the call of the same place in the turn before.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercaflow.llm.tool_calls import CALL, Parameter, Schemas

SCHEMAS: Schemas = {
    "search": {"query": Parameter("STRING"), "limit": Parameter("BIGINT"), "page": Parameter("BIGINT", required=False)},
    "count": {"text": Parameter("STRING")},
}


def tool_messages(conversations: DataFrame) -> DataFrame:
    """``messages`` as ``link_tool_calls`` takes them."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    name = lambda turn, i: F.concat(F.lit("c"), "conv_id", F.lit("_"), turn, F.lit("_"), i)

    def call(line, i):
        size = F.length(line)
        search = F.when(
            size % 5 == 0, F.to_json(F.struct(F.lit("many").alias("limit"), line.alias("query")))
        ).otherwise(F.to_json(F.struct(line.alias("query"), size.alias("limit"))))
        count = F.when(size % 7 == 0, F.to_json(F.struct(line.alias("text"), F.lit(1).alias("extra")))).otherwise(
            F.to_json(F.struct(line.alias("text")))
        )
        after = F.when((size % 2 == 1) & (i + 1 < F.size(lines)), F.array(name(F.col("turn"), i + 1)))
        return F.struct(
            name(F.col("turn"), i).alias("id"),
            F.when(size % 3 == 0, "count").otherwise("search").alias("name"),
            F.when(size % 3 == 0, count).otherwise(search).alias("arguments"),
            F.coalesce(after, F.array().cast("array<string>")).alias("after"),
        )

    asking = conversations.filter("role = 'user'").select(
        "conv_id", "turn", "role", "text", F.transform(lines, call).cast(f"array<{CALL}>").alias("tool_calls"),
        F.lit(None).cast("string").alias("tool_call_id"),
    )
    answers = conversations.filter("role = 'assistant'").select(
        "conv_id", "turn", F.posexplode(lines).alias("i", "line")
    )
    answering = answers.select(
        "conv_id", "turn", F.lit("tool"), "line", F.lit(None).cast(f"array<{CALL}>"), name(F.col("turn") - 1, F.col("i"))
    )
    return asking.union(answering)


# The same in DuckDB.
SQL = r"""
WITH split AS (
    SELECT conv_id, turn, role, string_split(coalesce(text, ''), chr(10)) AS lines FROM conversations
), line AS (
    SELECT conv_id, turn, role, unnest(lines) AS line, unnest(range(len(lines))) AS i, len(lines) AS n FROM split
), call AS (
    SELECT DISTINCT conv_id, turn, i, line, length(line) AS size, 'c' || conv_id || '_' || turn || '_' || i AS id,
        length(line) % 2 = 1 AND i + 1 < n AS waits
    FROM line WHERE role = 'user'
), ordered AS (
    SELECT *, CAST(min(CASE WHEN NOT waits THEN i END) OVER (
        PARTITION BY conv_id, turn ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - i AS INTEGER) AS level
    FROM call
), answer AS (
    SELECT conv_id, 'c' || conv_id || '_' || (turn - 1) || '_' || i AS id, min(turn) AS turn, arg_min(line, turn) AS result
    FROM line WHERE role = 'assistant' GROUP BY ALL
), checked AS (
    SELECT o.conv_id, o.turn, o.id, o.i, o.level, a.result,
        CASE WHEN a.id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
        CASE WHEN size % 3 = 0 THEN 'count' ELSE 'search' END AS name,
        CASE WHEN size % 3 = 0 THEN CASE WHEN size % 7 = 0 THEN to_json({'extra': 1, 'text': line}) ELSE to_json({'text': line}) END
             WHEN size % 5 = 0 THEN to_json({'limit': 'many', 'query': line})
             ELSE to_json({'limit': size, 'query': line}) END AS arguments,
        CASE WHEN size % 3 = 0 THEN CASE WHEN size % 7 = 0 THEN ['unknown: extra'] ELSE CAST([] AS VARCHAR[]) END
             WHEN size % 5 = 0 THEN ['not BIGINT: limit'] ELSE CAST([] AS VARCHAR[]) END AS errors
    FROM ordered o LEFT JOIN answer a ON a.conv_id = o.conv_id AND a.id = o.id AND a.turn > o.turn
)
SELECT conv_id, turn, id AS call_id,
    CAST(row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, i) - 1 AS INTEGER) AS position, level, status,
    CAST(len(errors) AS INTEGER) AS n_errors,
    CAST(to_json({'arguments': arguments, 'errors': errors, 'id': id, 'level': level, 'name': name, 'result': result,
        'status': status}) AS VARCHAR) AS record
FROM checked
UNION ALL
SELECT conv_id, turn, id, NULL, NULL, 'orphan', NULL,
    CAST(to_json({'id': id, 'result': result, 'status': 'orphan'}) AS VARCHAR)
FROM answer a WHERE NOT EXISTS (FROM call c WHERE c.conv_id = a.conv_id AND c.id = a.id)
"""
