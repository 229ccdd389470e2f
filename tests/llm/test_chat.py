import json

from dimloom.llm import chat

MESSAGES = "conv_id long, turn long, role string, text string"
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, needs array<string>"
RESULTS = "conv_id long, turn long, call_id string, text string"
SCHEMA = {"add": {"type": "object", "required": ["a"], "additionalProperties": False,
                  "properties": {"a": {"type": "integer", "minimum": 0}, "b": {"type": ["string", "null"], "maxLength": 3, "enum": ["x", None, "long one"]}, "c": {"type": "array", "items": {"type": "number"}, "minItems": 1}}}}


def test_schema_violations():
    cases = [({"a": 1}, None), ({"a": 1.0}, None), ({"a": True}, "$.a: not of type integer"), ({}, "$.a: missing"), ([], "$: not of type object"), ({"a": -1}, "$.a: out of bounds"), ({"a": 1, "z": 1}, "$.z: unknown"),
             ({"a": 1, "b": None}, None), ({"a": 1, "b": "y"}, "$.b: not in enum"), ({"a": 1, "b": "long one"}, "$.b: wrong length"), ({"a": 1, "c": [1, "2"]}, "$.c[1]: not of type number"), ({"a": 1, "c": []}, "$.c: wrong length")]
    for value, want in cases:
        assert chat.violation(value, SCHEMA["add"]) == want


def test_links_levels_and_problems(spark):
    calls = [(1, 0, "p", "add", '{"b": "x", "a": 1}', []), (1, 2, "q", "add", '{"a":2}', ["p"]), (1, 4, "r", "add", '{"a":3}', ["p", "q"]), (1, 6, "s", "add", '{"a":-3}', ["nowhere"]),
             (2, 0, "u", "add", '{"a":1}', ["v"]), (2, 1, "v", "add", '{"a":1}', ["u"]), (2, 2, "w", "add", '{"a":1}', ["v"]), (3, 0, None, "add", "{}", None), (3, 1, "p", "add", '{"a":9}', None),
             (3, 2, "t", "nothing", "{}", []), (3, 3, "x", "add", "not json", []), (3, 4, "y", "add", None, []), (3, 5, "z", "add", '{"a": 1e999}', [])]
    results = [(1, 1, "p", "one"), (1, 3, "q", None), (1, 5, "r", ""), (1, 7, "r", "again"), (9, 0, "lost", "x"), (9, 1, None, "x"), *[(3, 9, k, "ok") for k in "stuvwxyz"]]
    out = chat.format_chat(spark.createDataFrame([(1, -1, "system", 'é "quoted"\n'), (None, None, None, None)], MESSAGES), spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS), SCHEMA).collect()
    assert len(out) == 2 + len(calls) + len(results)
    by = {(r.kind, r.conv_id, r.turn, r.call_id): (r.level, r.problem) for r in out}
    assert [by["call", 1, t, c] for t, c in ((0, "p"), (2, "q"), (4, "r"))] == [(0, None), (1, None), (2, None)]
    assert by["call", 1, 6, "s"] == (0, "unknown need") and by["call", 3, 0, None] == (None, "no id") and by["call", 3, 1, "p"] == (0, "repeated id")
    assert [by["call", 2, t, c][1] for t, c in ((0, "u"), (1, "v"), (2, "w"))] == ["cycle"] * 3
    assert by["call", 3, 2, "t"][1] == "unknown tool" and {by["call", 3, t, c][1] for t, c in ((3, "x"), (4, "y"), (5, "z"))} == {"arguments are not JSON"}
    assert by["result", 1, 7, "r"] == (2, "repeated id") and by["result", 9, 0, "lost"] == (None, "no call") and by["result", 9, 1, None] == (None, "no id")
    lines = {(r.kind, r.conv_id, r.turn): r.json for r in out}
    assert lines["call", 1, 0] == '{"arguments":{"a":1,"b":"x"},"id":"p","name":"add","type":"call"}'
    assert lines["message", 1, -1] == '{"content":"é \\"quoted\\"\\n","role":"system","type":"message"}' and all(json.loads(x) for x in lines.values())


def test_turns_and_empty_tables(spark):
    turns = [(1, 0, "user", "hi there"), (1, 1, "assistant", "yes"), (1, 2, "user", ""), (1, 3, "assistant", None), (2, 1, "assistant", "alone"), (None, 0, "user", "x"), (3, None, "user", None), (4, 0, None, None)]
    df = spark.createDataFrame(turns, MESSAGES)
    out = {(r.kind, r.conv_id, r.turn): (r.level, r.problem) for r in chat.format_chat(*chat.from_turns(df), chat.ASK).collect()}
    assert out == {("call", 1, 0): (0, None), ("call", 1, 2): (1, "$.question: wrong length"), ("result", 1, 1): (0, None), ("result", 1, 3): (1, None), ("result", 2, 1): (None, "no call"),
                   ("call", None, 0): (None, "no id"), ("call", 3, None): (None, "no id"), ("message", 4, 0): (None, None)}
    assert chat.format_chat(*chat.from_turns(df.limit(0)), chat.ASK).count() == 0


def plain_levels(needs):
    """call -> level by walking each path; None on a cycle or behind one."""
    out, on = {}, object()

    def level(c):
        if out.get(c) is on:
            return None
        if c not in out:
            out[c] = on
            under = [level(n) for n in needs[c] if n in needs]
            out[c] = None if None in under else 1 + max(under, default=-1)
        return out[c]

    import sys
    sys.setrecursionlimit(20_000)
    circles = set()
    for c in needs:  # a call whose walk meets itself
        seen, todo = set(), [n for n in needs[c] if n in needs]
        while todo:
            x = todo.pop()
            if x == c:
                circles.add(c)
                break
            if x not in seen:
                seen.add(x)
                todo += [n for n in needs[x] if n in needs]
    behind = dict.fromkeys(circles)
    out.update(behind)
    for c in needs:
        level(c)
    return out


def test_levels_of_long_chains_joints_and_circles(spark):
    import random

    rng = random.Random(4)
    needs = {f"c{k}": [f"c{k - 1}"] if k else [] for k in range(300)}                                  # a long chain
    needs |= {f"d{k}": [f"d{k - 1}", f"c{k * 7 % 300}"] if k % 9 == 8 else [f"d{k - 1}"] if k else [] for k in range(60)}  # joints on it
    needs |= {f"o{k}": [f"o{(k + 1) % 11}"] for k in range(11)} | {"p0": ["o3"], "p1": ["p0", "c5"], "p2": ["p1"], "p3": ["p2", "c1"]}  # a circle, and what is behind it
    needs |= {f"x{k}": rng.sample([f"x{j}" for j in range(k)] or ["nowhere"], min(k, rng.randint(0, 3))) for k in range(40)}
    needs |= {"self": ["self"], "twice": ["c4", "c4"], "two": ["c9", "e"], "e": ["c9"]}
    df = spark.createDataFrame([(c, n) for c, n in needs.items()], "call_id string, needs array<string>")
    assert {r.call_id: r.level for r in chat.levels(df).collect()} == plain_levels(needs)


def test_clashing_columns_and_long_texts(spark):
    from pyspark.sql import functions as F

    turns = [(1, k, "user" if k % 2 == 0 else "assistant", "word " * (100_000 if k == 2 else 3)) for k in range(40)]
    df = spark.createDataFrame(turns, MESSAGES)
    want = sorted(map(str, chat.format_chat(*chat.from_turns(df), chat.ASK).collect()))
    extra = df.withColumns({c: F.lit("x") for c in ("level", "kind", "call_id", "json", "problem", "needs", "at", "steps", "there", "arguments", "name")})
    assert len(want) == 40 and sorted(map(str, chat.format_chat(*chat.from_turns(extra), chat.ASK).collect())) == want
