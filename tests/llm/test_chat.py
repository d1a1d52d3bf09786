import json

import pytest

from lectern.llm import chat

FIELDS = "conv_id long, turn int, kind string, role string, call_id string, after string, name string, arguments string, content string, json string, depth int"


def test_links_orders_and_validates(spark):
    ask = '{"turn": 1, "prompt": "é\\u0041"}'
    rows = [
        (1, 3, "call", "assistant", "c", "b", "respond", ask, None, "x", 1),
        (1, 1, "call", "assistant", "a", None, "respond", ask, None, "x", 1),
        (1, 2, "call", "assistant", "b", "a", "respond", '{"prompt": 5}', None, "x", 1),
        (1, 4, "result", "tool", "b", None, None, None, "done", "x", 1),
        (1, 5, "result", "tool", "nobody", None, None, None, None, "x", 1),
        (1, 6, "message", "user", None, None, None, None, 'say "x"\n', "x", 1),
        (1, 7, "call", "assistant", None, None, "respond", ask, None, "x", 1),
        (2, 1, "call", "assistant", "p", "q", "respond", ask, None, "x", 1),
        (2, 2, "call", "assistant", "q", "p", "respond", ask, None, "x", 1),
        (2, 3, "call", "assistant", "r", "q", "respond", "{broken", None, "x", 1),
        (3, 1, "call", "assistant", "d", "gone", "other", "{}", None, "x", 1),
        (4, 1, "call", "assistant", "e", None, "respond", ask, None, "x", 1),
        (4, 2, "call", "assistant", "e", None, "respond", '{"prompt":"z","turn":9}', None, "x", 1),
        (4, 3, "result", "tool", "e", None, None, None, "one", "x", 1),
        (4, 4, "result", "tool", "e", None, None, None, "two", "x", 1),
    ]
    df = spark.createDataFrame(rows, FIELDS).repartition(4)
    got = {(r["conv_id"], r["turn"]): r for r in chat.link(df, {"respond": chat.RESPOND}, ["conv_id", "turn"]).collect()}
    state = {k: (r["status"], r["position"]) for k, r in got.items()}
    assert state == {
        (1, 1): ("unanswered", 1), (1, 2): ("invalid", 3), (1, 3): ("unanswered", 5), (1, 4): ("result", 4), (1, 5): ("orphan", None), (1, 6): ("message", 0), (1, 7): ("message", 0),
        (2, 1): ("cycle", None), (2, 2): ("cycle", None), (2, 3): ("cycle", None), (3, 1): ("invalid", 1), (4, 1): ("duplicate", 1), (4, 2): ("call", 1), (4, 3): ("result", 2), (4, 4): ("result", 2),
    }
    assert got[1, 1]["json"] == '{"role":"assistant","tool_call":{"arguments":{"prompt":"éA","turn":1},"id":"a","name":"respond"}}'
    assert got[1, 2]["errors"] == "$.turn: missing; $.prompt: not string" and got[3, 1]["errors"] == "unknown tool other"
    assert json.loads(got[1, 6]["json"]) == {"content": 'say "x"\n', "role": "user"}
    assert chat.link(df.limit(0), {}, ["conv_id"]).count() == 0


def test_long_chains_and_hot_identifiers(spark):
    rows = [(1, i, "call", "a", f"k{i}", f"k{i - 1}", "respond", '{"prompt":"p","turn":1}', None, "x", 1) for i in range(40)]
    rows += [(2, i, "result", "t", "k3", None, None, None, f"r{i % 3}", "x", 1) for i in range(200)] + [rows[3]] * 100
    got = chat.link(spark.createDataFrame(rows, FIELDS).repartition(4), {"respond": chat.RESPOND}, ["turn"])
    assert got.count() == len(rows)
    assert {r["call_id"]: r["position"] for r in got.where("status in ('call', 'unanswered')").collect()} == {f"k{i}": 2 * i + 1 for i in range(40)}


def test_nested_and_broken_arguments_and_rows_of_no_kind(spark):
    deep = "[" * 100_000 + "]" * 100_000
    long = json.dumps({"prompt": "é" * 300_000, "turn": 1}, ensure_ascii=False)
    rows = [
        (1, 1, "call", "a", "d1", None, "respond", deep, None, "x", 1),
        (1, 2, "call", "a", "d2", None, "respond", '{"a":' * 5000 + "1" + "}" * 5000, None, "x", 1),
        (1, 3, "call", "a", "s1", None, "respond", '{"prompt": "\\ud800", "turn": 1}', None, "x", 1),
        (1, 4, "call", "a", "s2", None, "respond", '{"\\udfff": 1}', None, "x", 1),
        (1, 5, None, "user", "k1", None, None, None, "no kind", "x", 1),
        (1, 6, "other", "user", "k2", None, None, None, None, "x", 1),
        (1, 7, "call", "a", "l1", None, "respond", long, None, "x", 1),
        (1, 8, "result", "tool", "l1", None, None, None, "", "x", 1),
        (1, 9, "call", "a", "n1", None, None, None, None, "x", 1),
    ]
    got = {r["turn"]: r for r in chat.link(spark.createDataFrame(rows, FIELDS), {"respond": chat.RESPOND}, ["turn"]).collect()}
    assert [got[i]["status"] for i in range(1, 10)] == ["invalid"] * 4 + ["message"] * 2 + ["call", "result", "invalid"]
    assert all(json.loads(got[i]["json"])["tool_call"]["arguments"] == rows[i - 1][7] for i in (1, 3, 4))
    assert got[1]["errors"] == "arguments are nested too deeply" and got[3]["errors"] == "arguments are not JSON"
    assert json.loads(got[7]["json"])["tool_call"]["arguments"] == json.loads(long)


def test_half_of_the_rows_without_a_call_or_an_identifier(spark):
    rows = [(1, i, "result", "t", "nowhere", None, None, None, f"r{i}", "x", 1) for i in range(300)]
    rows += [(1, i, "result", "t", None, None, None, None, f"r{i}", "x", 1) for i in range(300, 500)]
    got = chat.link(spark.createDataFrame(rows, FIELDS), {}, ["turn"]).collect()
    assert sorted((r["turn"], r["status"]) for r in got) == [(i, "orphan" if i < 300 else "message") for i in range(500)]


def test_turns(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", None), (2, 0, "assistant", "x"), (None, 0, "user", "y"), (3, None, "user", "z"), (4, 0, "system", "s"), (1, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = sorted((r["conv_id"] or 0, r["turn"] or 0, r["status"]) for r in chat.link(chat.from_turns(df), {"respond": chat.RESPOND}, ["conv_id", "turn"]).collect())
    assert got == [(0, 0, "message"), (1, 0, "call"), (1, 0, "call"), (1, 1, "result"), (1, 2, "invalid"), (2, 0, "orphan"), (3, 0, "message"), (4, 0, "message")]


@pytest.mark.parametrize(
    ("value", "schema", "bad"),
    [(True, {"type": "integer"}, 1), (3, {"type": ["string", "integer"], "maximum": 2}, 1), ([1, "a"], {"items": {"type": "integer"}, "minItems": 3}, 2), ({"a": 1, "b": 2}, {"properties": {"a": {"enum": [2]}}, "additionalProperties": False, "required": ["c"]}, 3), (None, {"type": "null"}, 0), (1.5, {"type": "number", "minimum": 1}, 0)],
)
def test_violations(value, schema, bad):
    assert len(chat.violations(value, schema)) == bad


def test_numbers_of_any_size(spark):
    digits = "-" + "7" * 6000
    rows = [
        (1, 1, "call", "a", "b1", None, "count", '{"n": %s}' % digits, None, "x", 1),
        (1, 2, "call", "a", "b2", None, "count", '{"n": 1e999}', None, "x", 1),
        (1, 3, "call", "a", "b3", None, "count", '{"n": NaN}', None, "x", 1),
        (1, 4, "call", "a", "b4", None, "count", '{"n": 1.50e2}', None, "x", 1),
    ]
    schema = {"type": "object", "properties": {"n": {"type": "number", "maximum": 200}}}
    got = {r["turn"]: r for r in chat.link(spark.createDataFrame(rows, FIELDS), {"count": schema}, ["turn"]).collect()}
    assert got[1]["json"] == '{"role":"assistant","tool_call":{"arguments":{"n":%s},"id":"b1","name":"count"}}' % digits and got[1]["errors"] is None
    assert [got[i]["errors"] for i in (2, 3, 4)] == ["a number is beyond doubles", "arguments are not JSON", None]
    assert '"n":150.0' in got[4]["json"] and json.loads(got[2]["json"])["tool_call"]["arguments"] == rows[1][7]


def test_kept_columns_with_the_names_of_others(spark):
    names = ["json", "errors", "times", "answered", "depth", "first_json", "uses", "status", "kind", "call_id", "__none", "__keep"]
    more = [c for c in names if c not in ("json", "depth", "kind", "call_id")]
    rows = [(1, 1, "call", "a", "k", None, "respond", '{"prompt":"p","turn":1}', None, "own json", 5, *range(len(more))), (1, 2, "result", "t", "k", None, None, None, "r", None, 6, *range(len(more)))]
    df = spark.createDataFrame(rows, FIELDS + "".join(f", `{c}` int" for c in more))
    out = chat.link(df, {"respond": chat.RESPOND}, names)
    assert out.columns == [f"kept_{c}" if c in chat.RESULT else c for c in names] + list(chat.RESULT)
    got = {r["kind"]: r for r in out.collect()}
    assert got["call"]["kept_json"] == "own json" and got["call"]["status"] == "call" and got["call"]["depth"] == 5 and got["result"]["uses"] == more.index("uses")
    assert chat.link(df, {"respond": chat.RESPOND}, []).columns == list(chat.RESULT)
