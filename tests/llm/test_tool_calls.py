import json

from mercaflow.llm.tool_calls import CALL, Parameter, link_tool_calls

SCHEMAS = {"find": {"q": Parameter("STRING"), "n": Parameter("BIGINT", required=False)}}
SCHEMA = f"conv_id long, turn long, role string, text string, tool_calls array<{CALL}>, tool_call_id string, level string"


def call(name, arguments, *after, tool="find"):
    return (name, tool, arguments, list(after))


def test_calls_are_linked_ordered_checked_and_written(spark):
    calls = [
        call("a", '{"q": "x", "n": 2}', "b", "c"), call("b", '{"n": "2", "z": 1}', "c"), call("c", '{"q": "é\\"", "n": null}'),
        call("d", "[1]", "e"), call("e", "{bad", "d"), call("f", None, "nobody", tool="other"), call(None, '{"q": ""}'),
    ]
    rows = [
        (1, 0, "assistant", None, calls, None, "x"),
        (1, 0, "assistant", None, calls, None, "x"),
        (1, 1, "tool", "ra", None, "a", "x"),
        (1, 2, "tool", "later", None, "a", "x"),
        (1, 2, "tool", "lost", None, "q", "x"),
        (2, 0, "tool", "early", None, "a", "x"),
        (2, 1, "assistant", None, [call("a", '{"q": "1"}')], None, "x"),
        (2, 3, "assistant", None, [call("a", '{"q": "2"}')], None, "x"),
        (None, 0, "assistant", None, [call("a", '{"q": "1"}')], None, "x"),
        (3, 0, "tool", "early", None, "a", "x"),
        (3, None, "tool", "whenever", None, "a", "x"),
        (3, 1, "assistant", None, [call("a", '{"q": "3"}')], None, "x"),
        (3, 2, "tool", "valid", None, "a", "x"),
        (3, 2, "tool", None, None, "b", "x"),
    ]
    got = {(r.conv_id, r.turn, r.call_id): r for r in link_tool_calls(spark.createDataFrame(rows, SCHEMA), SCHEMAS).collect()}
    assert len(got) == 17
    first = {k[2]: r for k, r in got.items() if k[:2] == (1, 0)}
    assert {k: r.level for k, r in first.items()} == {"a": 2, "b": 1, "c": 0, "d": None, "e": None, "f": 0, None: None}
    assert [k for k, _ in sorted(first.items(), key=lambda x: x[1].position)] == ["c", "f", "b", "a", "d", "e", None]
    assert (first["a"].status, first["b"].status, got[1, 2, "q"].status) == ("linked", "unanswered", "orphan")
    assert first["b"].errors == ["missing: q", "not BIGINT: n", "unknown: z"]
    assert first["a"].errors == [] and first["d"].errors == ["not an object"] and first["f"].errors == ["unknown tool"]
    assert first["e"].errors == ["not an object"]
    record = json.loads(first["a"].record)
    assert record["result"] == "ra" and record["arguments"] == {"n": 2, "q": "x"}
    assert '"arguments":{"n":2,"q":"x"}' in first["a"].record and list(record) == sorted(record)
    assert (got[2, 1, "a"].status, got[2, 3, "a"].status) == ("unanswered", "duplicate")
    assert got[None, 0, "a"].status == "unanswered"
    # Results before the call, without a turn or after the first answer hide nothing and are not hidden.
    assert (got[1, 2, "a"].status, got[2, 0, "a"].status) == ("surplus", "surplus")
    assert got[3, 1, "a"].status == "linked" and json.loads(got[3, 1, "a"].record)["result"] == "valid"
    assert [got[3, t, "a"].status for t in (0, None)] == ["surplus", "surplus"]
    assert json.loads(got[3, None, "a"].record) == {"id": "a", "result": "whenever", "status": "surplus"}
    assert got[3, 2, "b"].status == "orphan" and json.loads(got[3, 2, "b"].record)["result"] is None


def test_no_messages(spark):
    assert link_tool_calls(spark.createDataFrame([], SCHEMA), SCHEMAS).collect() == []
