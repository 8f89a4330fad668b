"""Tool-call linking for chat formatting, in DataFrame functions.

Calls and results are joined by conversation and identifier; calls are ordered
by what they wait for; their arguments are checked against the schemas of the
tools; and each call is written as canonical JSON: keys sorted, no spaces.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from mercaflow.llm.storage import stored

CALL = "struct<id: string, name: string, arguments: string, after: array<string>>"
KEY = ["conv_id", "call_id"]


@dataclass(frozen=True)
class Parameter:
    """``kind`` is the SQL type that JSON values of the parameter have."""

    kind: str
    required: bool = True


Schemas = dict[str, dict[str, Parameter]]


def _errors(schemas: Schemas) -> Column:
    """What is wrong with ``arguments``, as sorted texts."""
    parsed = F.try_parse_json("arguments")
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    chosen: Column = F.array(F.lit("unknown tool"))
    for tool, parameters in schemas.items():
        found = [
            F.transform(
                F.array_except(F.json_object_keys("arguments"), F.array(*map(F.lit, parameters)).cast("array<string>")),
                lambda key: F.concat(F.lit("unknown: "), key),
            )
        ]
        for name, parameter in parameters.items():
            kind = F.schema_of_variant(F.try_variant_get(parsed, f"$.{name}", "variant"))
            absent = F.when(kind.isNull(), F.lit(f"missing: {name}") if parameter.required else F.lit(None))
            found.append(F.array(absent.when(kind != parameter.kind, F.lit(f"not {parameter.kind}: {name}"))))
        errors = F.array_sort(F.array_compact(F.concat(*found)))
        own = F.when(F.coalesce(is_object, F.lit(False)), errors).otherwise(F.array(F.lit("not an object")))
        chosen = F.when(F.col("name") == tool, own).otherwise(chosen)
    return chosen


def _levels(calls: DataFrame) -> DataFrame:
    """``conv_id``, ``call_id`` and ``level`` of the calls that wait for nothing,
    directly or not, but other calls; those in or behind a circle are left out.
    There is one round for each step of the longest chain."""
    waits = calls.select(*KEY, F.explode(F.array_distinct("after")).alias("other"))
    # Identifiers of no call are not waited for.
    known = calls.select("conv_id", F.col("call_id").alias("other"))
    waits = stored(waits.join(known, ["conv_id", "other"]), "waits")
    waiting = waits.groupBy(KEY).agg(F.count(F.lit(1)).alias("n_waits"))
    levels = stored(calls.select(KEY).join(waiting, KEY, "left_anti").withColumn("level", F.lit(0)), "levels")
    while not waits.isEmpty():
        met = waits.join(levels.withColumnRenamed("call_id", "other"), ["conv_id", "other"], "left")
        state = met.groupBy(KEY).agg(
            F.count(F.lit(1)).alias("n_waits"), F.count("level").alias("n_met"), (F.max("level") + 1).alias("level")
        )
        ready = stored(state.filter("n_waits = n_met").select(*KEY, "level"), "ready")
        if ready.isEmpty():
            break
        levels = stored(levels.union(ready), "levels")
        waits = stored(waits.join(ready.select(KEY), KEY, "left_anti"), "waits")
    return levels


def link_tool_calls(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """A row for each tool call, and for each result that answers none.

    ``messages``: ``conv_id``, ``turn``, ``role``, ``text``, ``tool_calls``
    (an array of ``CALL``) and ``tool_call_id``, which a row of role ``tool``
    has. Of several results with one identifier the first by turn and text that
    comes after the call counts; the others, and those before the call or without
    a turn, are rows of their own with status ``surplus``. Of several calls with
    one identifier the first counts, the others have status ``duplicate``.

    Columns: ``conv_id``, ``turn``, ``call_id``, ``position`` (from 0, the order
    in which the calls of a turn can run), ``level`` (steps of calls to wait
    for; null in or behind a circle, and such calls come last), ``status``
    (``linked``, ``unanswered``, ``duplicate``, ``surplus`` or ``orphan``), ``errors`` and
    ``record``, canonical JSON. A null conversation or identifier links with
    nothing. Equal rows count once. Other columns are not looked at.
    """
    calls = messages.select("conv_id", "turn", F.posexplode("tool_calls").alias("index", "call"))
    calls = calls.select(
        "conv_id", "turn", "index", F.col("call.id").alias("call_id"), "call.name", "call.arguments", "call.after"
    ).dropDuplicates([*KEY, "turn", "index"])
    calls = stored(calls, "calls")
    firsts = calls.groupBy(KEY).agg(F.min(F.struct("turn", "index")).alias("first"))
    results = messages.filter("role = 'tool'").select("conv_id", F.col("tool_call_id").alias("call_id"), "turn", "text")
    # Each with its call, and whether it comes after it; only answers compete for a call.
    results = results.distinct().join(firsts, KEY, "left").select(
        *KEY, F.struct("turn", "text").alias("result"), F.col("first").isNotNull().alias("has_call"),
        F.coalesce(F.col("turn") > F.col("first.turn"), F.lit(False)).alias("after"),
    )
    results = stored(results, "results")
    answers = results.filter("after").groupBy(KEY).agg(F.min("result").alias("result"))
    own = calls.join(firsts, KEY, "left")
    is_first = F.coalesce(F.struct("turn", "index") == F.col("first"), F.lit(True))
    own = own.withColumn("is_first", is_first)
    levels = _levels(own.filter("is_first and conv_id is not null and call_id is not null"))
    linked = own.join(levels, KEY, "left").join(answers, KEY, "left")
    answered = F.col("is_first") & F.col("result").isNotNull()
    linked = linked.select(
        "conv_id", "turn", "index", "call_id", "name", "arguments",
        F.when(F.col("is_first"), F.col("level")).alias("level"),
        F.when(~F.col("is_first"), "duplicate").when(answered, "linked").otherwise("unanswered").alias("status"),
        F.when(answered, F.col("result.text")).alias("result"),
        _errors(schemas).alias("errors"),
    )
    order = Window.partitionBy("conv_id", "turn").orderBy(F.col("level").asc_nulls_last(), "index")
    record = F.to_json(
        F.struct(
            F.try_parse_json("arguments").alias("arguments"), "errors", F.col("call_id").alias("id"), "level", "name",
            "result", "status",
        ),
        {"ignoreNullFields": "false"},
    )
    done = linked.select(
        "conv_id", "turn", "call_id", (F.row_number().over(order) - 1).alias("position"), "level", "status", "errors",
        record.alias("record"),
    )
    used = answers.withColumnRenamed("result", "used")
    lost = results.join(used, KEY, "left").filter(F.col("used").isNull() | ~F.col("result").eqNullSafe(F.col("used")))
    nothing, status = F.lit(None), F.when(F.col("has_call"), "surplus").otherwise("orphan")
    record = F.to_json(
        F.struct(F.col("call_id").alias("id"), F.col("result.text").alias("result"), status.alias("status")),
        {"ignoreNullFields": "false"},
    )
    return done.union(
        lost.select(
            "conv_id", "result.turn", "call_id", nothing.cast("int"), nothing.cast("int"), status,
            nothing.cast("array<string>"), record,
        )
    )
