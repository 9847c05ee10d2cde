from __future__ import annotations

import json

import duckdb
import pytest

from fabpulse.llm import tool_calls
from fabpulse.llm.tool_calls import Argument

SCHEMAS = {"add": {"a": Argument("number", least=0, most=10), "b": Argument("integer", required=False)},
           "note": {"text": Argument("string", min_length=2), "tags": Argument("array", required=False),
                    "deep": Argument("object", required=False), "on": Argument("boolean", required=False)},
           "none": {}}


@pytest.fixture
def linked(llm):
    def run(calls, results):
        made = llm.createDataFrame(calls, "call_id string, conv_id long, tool string, arguments string, after string")
        got = llm.createDataFrame(results, "call_id string, conv_id long, content string")
        return tool_calls.link(made, got, SCHEMAS).collect()
    return run


def test_linking_and_status(linked):
    calls = [("a", 1, "add", '{"a": 1}', None), ("b", 1, "add", '{"a": 2, "b": 3}', "a"),
             ("c", 1, "none", "{}", "b"), ("d", 2, "none", "{}", "gone"),
             ("x", 3, "none", "{}", "y"), ("y", 3, "none", "{}", "x"), ("z", 3, "none", "{}", "x"),
             ("s", 3, "none", "{}", "s"), (None, 4, "none", "{}", None), (None, 4, "none", "{}", None),
             ("a", 1, "add", '{"a": 1}', None)]
    results = [("a", 1, "one"), ("b", 1, "later"), ("b", 1, "earlier"), ("q", 9, "lost"), (None, 5, "who"),
               ("d", 2, None)]
    rows = linked(calls, results)
    by_id = {r.call_id: r for r in rows if r.call_id}
    assert {i: (r.status, r.level) for i, r in by_id.items()} == {
        "a": ("ok", 0), "b": ("ok", 1), "c": ("unanswered", 2), "d": ("ok", 0), "q": ("orphan", None),
        "x": ("cyclic", None), "y": ("cyclic", None), "z": ("cyclic", None), "s": ("cyclic", None)}
    assert by_id["b"].message == '{"arguments":{"a":2,"b":3},"id":"b","name":"add","result":"earlier"}'
    assert (by_id["a"].calls, by_id["b"].results, by_id["q"].conv_id) == (2, 2, 9)
    assert sorted(r.conv_id for r in rows if r.status == "nameless") == [4, 4, 5]


@pytest.mark.parametrize("tool, arguments, wrong", [
    ("add", '{"a": 10.0}', ""), ("add", '{"a": 11}', "a: too large"), ("add", '{"a": -1}', "a: too small"),
    ("add", '{"a": "1"}', "a: not of type number"), ("add", "{}", "a: missing"),
    ("add", '{"a": null}', "a: not of type number"), ("add", '{"a": 1, "b": 1.5}', "b: not of type integer"),
    ("add", '{"a": 1, "c": 2, "d": 3}', "c: not in the schema; d: not in the schema"),
    ("add", "[1]", "arguments: not an object"), ("add", "{oops", "arguments: not an object"),
    ("add", None, "arguments: not an object"), ("sub", "{}", "unknown tool"), (None, "{}", "unknown tool"),
    ("note", '{"text": "x"}', "text: too short"), ("none", "{}", ""),
    ("note", '{"text": "xy", "tags": [1], "deep": {"k": []}, "on": true}', "")])
def test_validation(linked, tool, arguments, wrong):
    row, = linked([("a", 1, tool, arguments, None)], [("a", 1, "r")])
    assert row.errors == wrong and row.status == ("invalid" if wrong else "ok")


def test_canonical_json(linked):
    given = '{ "text" : "é \\u00e9 \\n \\"q\\" / \U0001f600", "deep": {"z": [1, {"y": 2, "a": null}], "b": false} }'
    row, = linked([("id 1", 1, "note", given, None)], [("id 1", 1, "out\tput")])
    whole = {"id": "id 1", "name": "note", "result": "out\tput", "arguments": json.loads(given)}
    assert row.message == json.dumps(whole, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_levels_of_a_long_chain_and_a_fan(llm):
    rows = [(f"c{i}", f"c{i - 1}" if i else None) for i in range(200)] + [(f"f{i}", "c3") for i in range(50)]
    found = {r.call_id: r.level for r in tool_calls.levels(
        llm.createDataFrame(rows, "call_id string, after string")).collect()}
    assert found == {**{f"c{i}": i for i in range(200)}, **{f"f{i}": 4 for i in range(50)}}


def conversation(rows, llm):
    return llm.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_query_agrees_with_sql(llm):
    rows = [(c, t, ("system" if c % 3 == 0 and t == 0 else "user" if (t + (c % 3 == 0)) % 2 == 0 else "assistant"),
             f'Text "{c}" of\nturn {t} ' * ((c * t) % 60 + (c % 5 > 0))) for c in range(40) for t in range(1 + c % 12)]
    turns = conversation(rows, llm)
    found = tool_calls.link(*tool_calls.conversation_calls(turns), tool_calls.SCHEMAS)
    con = duckdb.connect()
    con.register("conversations", turns.toPandas())
    expected = con.sql(tool_calls.ORACLE).fetchall()
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)
    assert {r[7] for r in expected} == {"ok", "invalid", "unanswered", "orphan"} or len(expected) > 100


def test_hard_rows_and_empty_tables(llm):
    rows = [(1, 0, "user", None), (1, 1, "assistant", None), (None, 0, "user", "x"), (1, None, "assistant", "y"),
            (2, 0, None, "z"), (3, 0, "user", "w " * 100_000), (1, 0, "user", None)]
    found = tool_calls.link(*tool_calls.conversation_calls(conversation(rows, llm)), tool_calls.SCHEMAS).collect()
    assert sorted((r.status, r.calls, r.results) for r in found) == [
        ("invalid", 1, 0), ("invalid", 2, 1), ("nameless", 0, 1), ("nameless", 1, 0)]
    empty = conversation(rows, llm).limit(0)
    assert tool_calls.link(*tool_calls.conversation_calls(empty), tool_calls.SCHEMAS).count() == 0


def test_identifiers_count_within_their_conversation(linked):
    convs = [None, 1, 2, 3]
    calls = [(f"call_{n}", c, "add", f'{{"a": {n}}}', f"call_{n - 1}") for c in convs for n in range(3)]
    calls.append(("lone", 1, "none", "{}", "theirs"))
    results = [(f"call_{n}", c, f"result {n} of {c}") for c in convs for n in range(3)]
    results += [("lone", 2, "of another"), ("theirs", 2, "x")]
    rows = linked(calls, results)
    assert sorted(((r.conv_id, r.call_id, r.status, r.level, r.calls, r.results) for r in rows), key=repr) == sorted(
        [(c, f"call_{n}", "ok", n, 1, 1) for c in convs for n in range(3)]
        + [(1, "lone", "unanswered", 0, 1, 0), (2, "lone", "orphan", None, 0, 1),
           (2, "theirs", "orphan", None, 0, 1)], key=repr)
    for row in rows:
        if row.status == "ok":
            assert json.loads(row.message)["result"] == f"result {row.level} of {row.conv_id}"


@pytest.mark.parametrize("conv", [1, None])
def test_differing_rows_under_one_key_are_kept(linked, conv):
    calls = [("a", conv, "add", f'{{"a": {n % 20}}}', None) for n in range(60)] + [
        ("a", conv, None, None, None), ("a", 7, "none", "{}", None)]
    results = [("a", conv, f"text {n}") for n in range(300)] + [("a", conv, None), ("a", 7, "r"), ("a", 7, "r")]
    rows = linked(calls, results)
    first, = (r for r in rows if r.conv_id == conv and r.status != "duplicate")
    assert (first.status, first.calls, first.results, json.loads(first.message)) == (
        "invalid", 61, 301, {"id": "a"})
    other, = (r for r in rows if r.conv_id == 7)
    assert (other.status, other.calls, other.results) == ("ok", 1, 2)
    more = [r for r in rows if r.status == "duplicate"]
    assert sorted(json.loads(r.message)["result"] for r in more if r.results) == sorted(
        f"text {n}" for n in range(300))
    assert sorted((json.loads(r.message)["arguments"]["a"], r.calls, r.errors) for r in more if r.calls) == [
        (n, 3, "a: too large" if n > 10 else "") for n in range(20)]
    assert all(r.level is None and (r.conv_id, r.call_id) == (conv, "a") for r in more)


def test_turns_repeated_with_other_texts_lose_none(llm):
    rows = [(1, 0, "user", "one"), (1, 0, "user", "two"), (1, 1, "assistant", "three"), (1, 1, "assistant", "four")]
    found = tool_calls.link(*tool_calls.conversation_calls(conversation(rows, llm)), tool_calls.SCHEMAS).collect()
    assert sorted(r.status for r in found) == ["duplicate", "duplicate", "ok"]
    assert all(any(text in r.message for r in found) for _, _, _, text in rows)
