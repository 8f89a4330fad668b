"""Conversations with damage that follows from their keys, for the repair to mend."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text``: by crc32 of ``conv_id:turn``
    modulo 20 a row is dropped (0), emptied (1), robbed of its full stops, question
    and exclamation marks (2), repeated (3), or given to the user (4). Nulls count
    as one space."""
    blank = F.lit(" ")
    key = F.concat(*(F.coalesce(c, blank) for c in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))))
    code = F.pmod(F.crc32(key), F.lit(20))
    role, text = (F.coalesce(c, blank) for c in ("role", "text"))
    rows = conversations.select("conv_id", "turn", code.alias("code"), role.alias("role"), text.alias("text"))
    rows = rows.filter("code <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "")
        .when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")
