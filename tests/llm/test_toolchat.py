import json
import random

import pytest

from netaudit.llm.toolchat import linked, ordered

CALLS, RESULTS = "conv_id long, call_id string, turn long, name string, arguments string", "conv_id long, call_id string, turn long, content string"
NEEDS, RULES = "conv_id long, call_id string, needed string", "name string, field string, kind string, required boolean, least double, most double"
SCHEMA = [("t", "x", "integer", True, 0.0, 5.0), ("t", "s", "string", True, None, None), ("t", "o", "number", False, None, None)]


def run(spark, calls, results=(), needs=(), rules=SCHEMA):
    rows = linked(*(spark.createDataFrame(list(d), s) for d, s in ((calls, CALLS), (results, RESULTS), (rules, RULES), (needs, NEEDS))))
    return {(r.conv_id, r.call_id): r for r in rows.collect()}


@pytest.mark.parametrize(("arguments", "valid", "canonical"), [
    ('{"x": 1, "s": "q"}', True, '{"s":"q","x":1}'), ('{"s":"é\\n","x":5,"o":2.5}', True, '{"o":2.5,"s":"é\\n","x":5}'), ('{"s":"","x":0,"o":7}', True, '{"o":7,"s":"","x":0}'),
    ('{"x":6,"s":"q"}', False, '{"s":"q","x":6}'), ('{"x":"1","s":"q"}', False, '{"s":"q","x":"1"}'), ('{"x":1}', False, '{"x":1}'), ('{"x":1,"s":"q","z":[]}', False, '{"s":"q","x":1,"z":[]}'),
    ('{"x":1.5,"s":"q"}', False, '{"s":"q","x":1.5}'), ('{"x":null,"s":"q"}', False, '{"s":"q","x":null}'), ("{}", False, "{}"), ("[1]", False, "null"), ("not json", False, "null"), (None, False, "null"),
])
def test_validation_and_canonical_arguments(spark, arguments, valid, canonical):
    row = run(spark, [(1, "a", 1, "t", arguments)])[1, "a"]
    assert row.valid is valid
    assert row.json == f'{{"arguments":{canonical},"id":"a","name":"t","result":null,"turn":1,"type":"call"}}'


@pytest.mark.parametrize(("name", "written"), [
    ('a"b', '"a\\"b"'), ("a.b", '"a.b"'), ("a[0]", '"a[0]"'), ("", '""'), ("$", '"$"'), ("a'b", '"a\'b"'), ("é\n", '"é\\n"'), ("a]b", '"a]b"'), ("\\", '"\\\\"'), ("*", '"*"'),
])
def test_any_field_name(spark, name, written):
    rules = [("t", name, "integer", True, 0.0, 5.0)]
    for value, valid in (("1", True), ("9", False), ('"x"', False)):
        row = run(spark, [(1, "a", 1, "t", json.dumps({name: json.loads(value)}, ensure_ascii=False))], rules=rules)[1, "a"]
        assert row.valid is valid and row.json.startswith(f'{{"arguments":{{{written}:{value}}},')
        assert json.loads(row.json)["arguments"] == {name: json.loads(value)}


@pytest.mark.parametrize(("arguments", "held"), [
    ('{"x":1e400}', False), ('{"x":[{"y":-1E+999}]}', False), ('{"x":"1e400"}', True), ('{"x":"a\\"1e400"}', True), ('{"x":1e300}', True), ('{"x":' + "9" * 400 + "}", False), ('{"a":1,"a":2}', False),
])
def test_numbers_that_json_cannot_give_back(spark, arguments, held):
    row = run(spark, [(1, "a", 1, "t", arguments)])[1, "a"]
    assert row.valid is False and (json.loads(row.json)["arguments"] is not None) is held and "Infinity" not in row.json


def test_messages_and_collapsed_calls(spark):
    frames = [spark.createDataFrame(list(d), s) for d, s in (([(1, "a", 1, "t", "{}"), (1, "a", 1, "t", "{}"), (1, "a", 2, "t", "{}")], CALLS), ([], RESULTS), (SCHEMA, RULES), ([], NEEDS))]
    messages = spark.createDataFrame([(1, 0, "system", 'be "kind"'), (1, 0, "system", 'be "kind"'), (None, None, None, None)], "conv_id long, turn int, role string, content string")
    rows = linked(*frames, messages).collect()
    assert [(r.n_calls, r.turn) for r in rows if r.call_id == "a"] == [(3, 1)]
    others = [r for r in rows if r.call_id is None]
    assert sorted((r.conv_id or 0, r.turn, r.linked, r.valid) for r in others if r.conv_id) == [(1, 0, False, None)] * 2
    assert json.loads(others[0].json)["type"] == "message" and {r.json for r in others if r.conv_id is None} == {'{"content":null,"role":null,"turn":null,"type":"message"}'}


def test_links_ties_and_left_overs(spark):
    text = 'q"uo\\te\né\t'
    got = run(
        spark, [(1, "a", 2, "t", "{}"), (1, "a", 2, "t", "{}"), (1, "a", 1, "u", "{}"), (2, "a", 1, "t", "{}"), (None, "a", 1, "t", "{}"), (1, None, 1, "t", "{}")],
        [(1, "a", 4, "later"), (1, "a", 3, text), (1, "a", 3, text), (1, "zz", 9, None), (None, "a", 1, "lost")],
    )
    assert set(got) == {(1, "a"), (2, "a"), (1, "zz")}
    assert (got[1, "a"].linked, got[1, "a"].n_results, got[1, "a"].turn, got[1, "a"].valid) == (True, 3, 1, False)
    assert json.loads(got[1, "a"].json) == {"arguments": {}, "id": "a", "name": "u", "result": {"content": text, "turn": 3}, "turn": 1, "type": "call"}
    assert not got[2, "a"].linked and got[1, "zz"].valid is None and json.loads(got[1, "zz"].json) == {"id": "zz", "result": {"content": None, "turn": 9}, "type": "result"}


def test_order_of_random_needs(spark):
    """Every call comes after what it needs; calls on or behind a cycle, and only these, are cyclic."""
    rng = random.Random(4)
    calls = [(c, f"k{i}", rng.randrange(12)) for c in range(12) for i in range(15)]
    needs = [(c, f"k{rng.randrange(15)}", f"k{rng.randrange(18)}") for c in range(12) for _ in range(2 * c)]
    rows = ordered(spark.createDataFrame(calls, "conv_id long, call_id string, turn long"), spark.createDataFrame(needs, NEEDS)).collect()
    place, cyclic = {(r.conv_id, r.call_id): (r.place, r.step) for r in rows}, {(r.conv_id, r.call_id) for r in rows if r.cyclic}
    edges = {((c, a), (c, b)) for c, a, b in needs if (c, b) in place}
    left = set(place)
    while free := {x for x in left if not any(a == x and b in left for a, b in edges)}:
        left -= free
    assert cyclic == left and len(left) > 10
    assert len(rows) == len(calls)
    assert all(place[a] > place[b] for a, b in edges if a not in left)


def test_long_chain_against_the_turns(spark):
    """One conversation whose calls each need the next one: rounds follow the logarithm of its length."""
    n = 3000
    calls = spark.range(n).selectExpr("7L as conv_id", "concat('k', id) as call_id", "id as turn")
    needs = spark.range(n).selectExpr("7L as conv_id", "concat('k', id) as call_id", "concat('k', id + 1) as needed")
    rows = ordered(calls, needs).collect()
    assert {(int(r.call_id[1:]), r.place, r.step) for r in rows} == {(i, n - 1, n - 1 - i) for i in range(n)}


def test_empty_tables(spark):
    assert run(spark, []) == {}
    assert len(run(spark, [], [(1, "a", 2, "x")])) == 1
