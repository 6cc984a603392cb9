"""Tool calls: order, links, schemas, canonical JSON."""

import json
import random

import pytest

from tidespan.llm import chat
from tidespan.llm.queries import TOOLS, tool_log

SCHEMAS = {"t": {"type": "object", "required": ["a"], "properties": {"a": {"type": "integer", "minimum": 0}}, "additionalProperties": False}}
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, refers array<string>, status string"
RESULTS = "conv_id long, turn long, call_id string, content string"
GOOD = '{"a": 1}'


def test_canonical():
    assert chat.canonical({"b": [1.0, None, True], "a": {"é": 'x"\n', "Z": 1e300, "z": 0.5}}) == '{"a":{"Z":1e+300,"z":0.5,"é":"x\\"\\n"},"b":[1,null,true]}'
    with pytest.raises(ValueError):
        chat.canonical(float("nan"))


@pytest.mark.parametrize("value,schema,wrong", [
    (1, {"type": "integer"}, 0), (1.0, {"type": "integer"}, 0), (1.5, {"type": "integer"}, 1), (True, {"type": "integer"}, 1),
    (True, {"type": ["boolean", "null"]}, 0), ("x", {"enum": ["y"]}, 1), ("x", {"const": "x"}, 0), (5, {"maximum": 4}, 1),
    ("abc", {"minLength": 4}, 1), ("abc", {"maxLength": 2, "pattern": "^a"}, 1), ([1, "x"], {"items": {"type": "integer"}}, 1),
    ([], {"minItems": 1}, 1), ({"b": 1}, SCHEMAS["t"], 2), ({"a": -1}, SCHEMAS["t"], 1), ({"a": 3}, SCHEMAS["t"], 0),
])
def test_schemas(value, schema, wrong):
    assert len(chat.violations(value, schema)) == wrong


def linked(spark, calls, results):
    out = chat.link(spark.createDataFrame([(*c, "x") for c in calls], CALLS), spark.createDataFrame(results, RESULTS), SCHEMAS)
    return out.collect()


def test_links_and_states(spark):
    calls = [
        (1, 0, "a", "t", GOOD, []), (1, 2, "b", "t", '{"a": "x"}', ["a"]), (1, 4, "c", "u", GOOD, None), (1, 6, "d", "t", "{", ["a", None]),
        (1, 8, "e", "t", GOOD, ["gone"]), (1, 9, "f", "t", GOOD, ["g"]), (1, 9, "g", "t", GOOD, ["f"]), (1, 11, "h", "t", GOOD, ["g"]),
        (1, 5, "a", "t", GOOD, []), (2, 0, "a", "t", GOOD, []), (2, 1, None, "t", GOOD, []), (None, None, "n", "t", GOOD, []), (2, 3, "s", "t", GOOD, ["s"]),
        (2, 4, "big", "t", '{"a": 7}' + " " * 100_000, []),
    ]
    results = [(1, 1, "a", "first"), (1, 3, "a", "second"), (1, 3, "b", None), (2, 9, "zz", "lost"), (2, 9, None, "lost too"), (None, 1, "n", ""), (2, 5, "big", "y")]
    rows = linked(spark, calls, results)
    again = [r for r in rows if r.status == "repeated"]
    assert sorted((r.conv_id, r.call_id, r.turn, r.call is None, r.result) for r in again) == [
        (1, "a", 3, True, '{"content":"second","id":"a"}'), (1, "a", 5, False, None),
    ]
    assert len(rows) == len(calls) + len(results) - sum(r.call is not None and r.result is not None for r in rows)
    rows = [r for r in rows if r.status != "repeated"]
    got = {(r.conv_id, r.call_id): r for r in rows}
    assert len(rows) == 15 and len(got) == 14
    status = {k: r.status for k, r in got.items() if k != (2, None)}
    assert status == {
        (1, "a"): "linked", (1, "b"): "invalid", (1, "c"): "invalid", (1, "d"): "invalid", (1, "e"): "dangling", (1, "f"): "circular",
        (1, "g"): "circular", (1, "h"): "circular", (2, "a"): "open", (None, "n"): "linked", (2, "s"): "circular", (2, "zz"): "orphan", (2, "big"): "linked",
    }
    assert sorted(r.status for r in rows if r.call_id is None) == ["orphan", "unnamed"]
    assert got[1, "a"].copies == 2 and json.loads(got[1, "a"].result) == {"content": "first", "id": "a"}
    assert got[1, "a"].call == '{"arguments":{"a":1},"id":"a","name":"t"}'
    assert got[1, "d"].call == '{"after":["a"],"arguments":null,"id":"d","name":"t"}'
    assert json.loads(got[1, "b"].result)["content"] is None and got[1, "d"].errors == "arguments are not JSON"


@pytest.mark.parametrize("seed", range(2))
def test_topological_order(spark, seed):
    """Random references with disturbed turns, and circles, against Kahn's algorithm."""
    rng = random.Random(seed)
    calls = []
    for conv in range(6):
        turns = list(range(12))
        if conv % 2:
            rng.shuffle(turns)
        for i in range(12):
            refers = [f"c{j}" for j in range(i) if rng.random() < 0.2]
            if conv == 4 and i == 3:
                refers.append("c9")
            calls.append((conv, turns[i] if conv != 5 else None, f"c{i}", "t", GOOD, refers))
    rows = {(r.conv_id, r.call_id): r for r in linked(spark, calls, [])}
    assert len(rows) == len(calls)
    for conv in range(6):
        refs = {c[2]: set(c[5]) for c in calls if c[0] == conv}
        free, more = set(), True
        while more:
            more = {c for c in refs if c not in free and refs[c] <= free}
            free |= more
        assert {c for c in refs if rows[conv, c].depth is None} == set(refs) - free
        for c in free:
            place = lambda x: (rows[conv, x].stage, rows[conv, x].depth)
            assert all(place(r) < place(c) for r in refs[c])


def test_every_repeated_row_is_returned(spark):
    """Two results for one call, equal ones too, and most rows under one identifier."""
    rows = linked(spark, [(1, 0, "x", "t", GOOD, [])] * 3, [(1, 1, "x", "one"), (1, 1, "x", "two"), (1, 1, "x", "two")] + [(1, 2, "x", str(i)) for i in range(200)])
    linked_row = next(r for r in rows if r.status == "linked")
    assert json.loads(linked_row.result)["content"] == "one" and linked_row.copies == 3
    again = [r for r in rows if r.status == "repeated"]
    assert sum(r.call is not None for r in again) == 2 and all(r.call_id == "x" and r.depth is None for r in again)
    contents = [json.loads(r.result)["content"] for r in again if r.result is not None]
    assert sorted(contents) == sorted(["two", "two", *map(str, range(200))])


def test_no_rows(spark):
    assert linked(spark, [], []) == []
    assert [r.status for r in linked(spark, [], [(1, 1, "a", "x")])] == ["orphan"]


def test_log_of_turns(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "user", "abc"), (1, 2, "assistant", "yes"), (1, 3, "user", "abcd"), (1, 4, "assistant", None), (2, 0, "user", None)]
    calls, results = tool_log(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = {r.call_id: r for r in chat.link(calls, results, TOOLS).collect()}
    assert rows["call-1-1"].status == "linked" and rows["call-1-3"].status == "linked" and rows["call-2-0"].status == "invalid"
    assert rows["call-1-1"].call == '{"arguments":{"limit":3,"query":"abc"},"id":"call-1-1","name":"search"}'
