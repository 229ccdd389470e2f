"""Chat formatting: tool calls linked with their results, ordered, validated and serialised.

* Calls and results are hash-joined by identifier. Of several calls (or
  results) with one identifier the first by turn counts; the others are
  reported, not dropped.
* Calls are ordered topologically by the calls they need: a call's level is
  one more than the largest level of its needs. Chains of calls that need one
  call each are pulled together by pointer doubling, so rounds grow with the
  logarithm of their length, and with the number of calls that need several on
  one path; calls left over stand on a cycle, or need one that does. Needs that
  no call has are reported.
* Arguments are validated against their tool's JSON schema, and every message
  is serialised as canonical JSON (sorted keys, no spaces, UTF-8) in Arrow
  batches.

One row per message, so a conversation of any length is never gathered; the
order within one is (turn, level, call_id, kind).

Defined results: a null text is JSON null; rows without a conversation or a
turn are formatted like others; a null call id links with nothing; empty
tables give an empty result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimloom.operators.ids import materialize

FORMATTED = "conv_id long, turn long, level long, kind string, call_id string, json string, problem string"
_TYPES = {"string": str, "boolean": bool, "object": dict, "array": list, "null": type(None)}


def canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def is_type(value: object, kind: str) -> bool:
    if kind in ("integer", "number"):
        return isinstance(value, (int, float)) and not isinstance(value, bool) and math.isfinite(value) and (kind == "number" or value == int(value))
    return isinstance(value, _TYPES[kind])


def violation(value: object, schema: Mapping, at: str = "$") -> str | None:
    """Where and how ``value`` first breaks a JSON schema (type, enum, bounds, lengths, properties, items), or None."""
    kinds = schema.get("type", [])
    if kinds and not any(is_type(value, k) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return f"{at}: not of type {kinds}"
    if "enum" in schema and value not in schema["enum"]:
        return f"{at}: not in enum"
    if is_type(value, "number") and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        return f"{at}: out of bounds"
    if isinstance(value, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(value, str) else ("minItems", "maxItems")
        if not schema.get(low, 0) <= len(value) <= schema.get(high, len(value)):
            return f"{at}: wrong length"
    if isinstance(value, dict):
        own = schema.get("properties", {})
        for name in schema.get("required", []):
            if name not in value:
                return f"{at}.{name}: missing"
        for name in sorted(value):
            if name in own:
                if found := violation(value[name], own[name], f"{at}.{name}"):
                    return found
            elif schema.get("additionalProperties") is False:
                return f"{at}.{name}: unknown"
    if isinstance(value, list) and "items" in schema:
        return next((found for k, x in enumerate(value) if (found := violation(x, schema["items"], f"{at}[{k}]"))), None)
    return None


def anchored(pointers: DataFrame, ends: DataFrame, count: int) -> DataFrame:
    """(call_id, at, steps): follow each call's one pointer (call_id, at, steps) to the first of the ``ends``.

    Pointer doubling: a round doubles the steps that are taken at once, so the
    rounds grow with the logarithm of the longest chain. After as many rounds
    as ``count`` calls could need, what has not arrived goes round in a circle,
    and is left out.
    """
    ends = ends.select(F.col("call_id").alias("at"), F.lit(True).alias("there"))
    now = materialize(pointers.join(ends, "at", "left").select("call_id", "at", "steps", F.coalesce("there", F.lit(False)).alias("there")), "chat-steps")
    for _ in range(max(1, count.bit_length()) + 1):
        if not now.where("not there").limit(1).count():
            break
        over = now.select(F.col("call_id").alias("at"), F.col("at").alias("next"), F.col("steps").alias("more"), F.col("there").alias("arrived"))
        moved = now.where("not there").join(over, "at").select("call_id", F.col("next").alias("at"), (F.col("steps") + F.col("more")).alias("steps"), F.col("arrived").alias("there"))
        now = materialize(now.where("there").union(moved), "chat-steps")
    return now.where("there").select("call_id", "at", "steps")


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level, unknown_needs) of calls (call_id, needs): level null on a cycle, or behind one.

    Calls that need one call only are chains, and are pulled together by pointer
    doubling. What stays are the *joints*, which need several: their edges lead to
    the ends of the chains, with the chain's length as weight. Joints whose edges
    all lead to one end are links of a longer chain, and so on, until none is left;
    else a round places the joints whose ends are all placed.
    """
    edges = calls.select("call_id", F.explode("needs").alias("need")).distinct()
    known = materialize(calls.select("call_id").distinct(), "chat-calls")
    missing = edges.join(known.withColumnRenamed("call_id", "need"), "need", "left_anti").groupBy("call_id").agg(F.count(F.lit(1)).alias("unknown_needs"))
    links = materialize(edges.join(known.withColumnRenamed("call_id", "need"), "need").select("call_id", F.col("need").alias("at"), F.lit(1).cast("long").alias("steps")), "chat-edges")
    count = known.count()
    placed = materialize(known.join(links.select("call_id").distinct(), "call_id", "left_anti").withColumn("level", F.lit(0).cast("long")), "chat-levels")
    hung = None  # chains (call_id, at, steps), the later ones first: their ends are placed before them
    while links.limit(1).count():
        ends = links.groupBy("call_id").agg(F.min("at").alias("at"), F.max("at").alias("other"), F.max("steps").alias("steps"))
        ends = materialize(ends, "chat-ends")
        single = ends.where("at = other").select("call_id", "at", "steps")
        joints = ends.where("at != other").select("call_id")
        if single.limit(1).count():
            chains = anchored(single, joints.union(placed.select("call_id")), count)
            hung = [chains, *(hung or [])]
            over = chains.select(F.col("call_id").alias("at"), F.col("at").alias("end"), F.col("steps").alias("more"))
            lost = single.select("call_id").join(chains.select("call_id"), "call_id", "left_anti").select(F.col("call_id").alias("at"), F.lit(True).alias("lost"))
            links = links.join(joints, "call_id", "left_semi").join(over, "at", "left").select("call_id", F.coalesce("end", "at").alias("at"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"))
            # a joint that needs a call of a circle is behind it, and never placed
            behind = links.join(lost, "at").select("call_id").distinct()
            links = materialize(links.join(behind, "call_id", "left_anti").groupBy("call_id", "at").agg(F.max("steps").alias("steps")), "chat-edges")
        else:
            met = links.join(placed.select(F.col("call_id").alias("at"), "level"), "at", "left").groupBy("call_id").agg(
                F.count_if(F.col("level").isNull()).alias("waiting"), F.max(F.col("level") + F.col("steps")).alias("level"))
            new = materialize(met.where("waiting = 0").select("call_id", "level"), "chat-levels")
            if not new.limit(1).count():
                break  # only circles are left, and what is behind them
            placed = materialize(placed.union(new), "chat-levels")
            links = materialize(links.join(new.select("call_id"), "call_id", "left_anti"), "chat-edges")
    for chains in hung or []:
        ends = placed.select(F.col("call_id").alias("at"), F.col("level").alias("base"))
        placed = materialize(placed.union(chains.join(ends, "at").select("call_id", (F.col("base") + F.col("steps")).alias("level"))), "chat-levels")
    return known.join(placed, "call_id", "left").join(missing, "call_id", "left").select("call_id", "level", F.coalesce("unknown_needs", F.lit(0)).alias("unknown_needs"))


def first_of(df: DataFrame, columns: list[str]) -> DataFrame:
    """The first row of each call id by turn, as ``first``."""
    return df.where("call_id is not null").groupBy("call_id").agg(F.min(F.struct(*columns)).alias("first"))


def format_chat(messages: DataFrame, calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping]) -> DataFrame:
    """Canonical JSON rows (``FORMATTED``).

    messages (conv_id, turn, role, text); calls (conv_id, turn, call_id, name,
    arguments as JSON, needs); results (conv_id, turn, call_id, text);
    ``schemas``: a JSON schema for each tool's name (a few, given by the user).
    """
    order = ["turn", "conv_id"]
    first_call, first_result = first_of(calls, [*order]), first_of(results, [*order])
    called = (calls.join(levels(calls.where("call_id is not null")), "call_id", "left").join(first_call, "call_id", "left")
              .join(first_result.select("call_id", F.lit(True).alias("answered")), "call_id", "left")
              .select("conv_id", "turn", "level", F.lit("call").alias("kind"), "call_id", F.col("name").alias("role"), F.col("arguments").alias("text"),
                      F.when(F.col("call_id").isNull(), "no id").when(~(F.col("first.turn").eqNullSafe(F.col("turn")) & F.col("first.conv_id").eqNullSafe(F.col("conv_id"))), "repeated id")
                      .when(F.col("level").isNull(), "cycle").when(F.col("unknown_needs") > 0, "unknown need").when(F.col("answered").isNull(), "no result").alias("problem")))
    answered = (results.join(levels_of(called), "call_id", "left").join(first_result, "call_id", "left")
                .select("conv_id", "turn", "level", F.lit("result").alias("kind"), "call_id", F.lit("tool").alias("role"), "text",
                        F.when(F.col("call_id").isNull(), "no id").when(F.col("is_call").isNull(), "no call")
                        .when(~(F.col("first.turn").eqNullSafe(F.col("turn")) & F.col("first.conv_id").eqNullSafe(F.col("conv_id"))), "repeated id").alias("problem")))
    plain = messages.select("conv_id", "turn", F.lit(None).cast("long").alias("level"), F.lit("message").alias("kind"), F.lit(None).cast("string").alias("call_id"), "role", "text", F.lit(None).cast("string").alias("problem"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in FORMATTED.split(", ")]
        for batch in batches:
            out, problems = [], []
            for kind, call_id, role, text, problem in zip(*(batch.column(c).to_pylist() for c in ("kind", "call_id", "role", "text", "problem"))):
                if kind == "call":
                    try:
                        arguments = json.loads(text)
                        wrong = violation(arguments, schemas[role]) if role in schemas else "unknown tool"
                        line = canonical({"type": "call", "id": call_id, "name": role, "arguments": arguments})
                    except (TypeError, ValueError):  # no JSON, or no finite numbers in it
                        wrong, line = "arguments are not JSON", canonical({"type": "call", "id": call_id, "name": role, "arguments": text})
                    problem = problem or wrong
                elif kind == "result":
                    line = canonical({"type": "result", "id": call_id, "content": text})
                else:
                    line = canonical({"type": "message", "role": role, "content": text})
                out.append(line)
                problems.append(problem)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:5]), pa.array(out, pa.string()), pa.array(problems, pa.string())], names)

    rows = plain.unionByName(called).unionByName(answered)
    return rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "level", "kind", "call_id", "role", "text", "problem").mapInArrow(write, FORMATTED)


def levels_of(called: DataFrame) -> DataFrame:
    return called.where("call_id is not null").groupBy("call_id").agg(F.min("level").alias("level"), F.lit(True).alias("is_call"))


#: The tool of the derived calls.
ASK = {"ask": {"type": "object", "required": ["question", "turn", "words"], "additionalProperties": False,
               "properties": {"question": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}, "words": {"type": "integer", "minimum": 1, "maximum": 60}}}}
WORDS = r"[^\x20\x09-\x0D]+"


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages, calls, results) of plain conversations (conv_id, turn, role, text).

    A user's turn calls the tool ``ask``, needs the user's call two turns
    earlier, and the next turn is its result if it is the assistant's.
    """
    named = lambda turn: F.concat_ws("-", F.lit("call"), "conv_id", turn)
    calls = turns.where("role = 'user'").select(
        "conv_id", "turn", F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), named(F.col("turn"))).alias("call_id"), F.lit("ask").alias("name"),
        F.to_json(F.struct(F.col("text").alias("question"), "turn", F.regexp_count("text", F.lit(WORDS)).alias("words"))).alias("arguments"),
        F.when(F.col("turn") >= 2, F.array(named(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("needs"))
    results = turns.where("role = 'assistant'").select("conv_id", "turn", F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), named(F.col("turn") - 1)).alias("call_id"), "text")
    return turns.where("role is null or role not in ('user', 'assistant')").select("conv_id", "turn", "role", "text"), calls, results


ORACLE = r"""
with recursive users as (select conv_id, turn, 'call-' || conv_id || '-' || turn as call_id, text,
                     len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words from conversations where role = 'user'),
ranked as (select conv_id, turn, 0::BIGINT as level from users u
           where turn < 2 or not exists (select 1 from users p where p.conv_id = u.conv_id and p.turn = u.turn - 2)
           union all
           select u.conv_id, u.turn, r.level + 1 from ranked r join users u on u.conv_id = r.conv_id and u.turn = r.turn + 2),
answers as (select conv_id, turn, 'call-' || conv_id || '-' || (turn - 1) as call_id, text from conversations where role = 'assistant')
select u.conv_id, u.turn, r.level, 'call' as kind, u.call_id,
       '{"arguments":{"question":' || to_json(u.text) || ',"turn":' || u.turn || ',"words":' || u.words || '},"id":"' || u.call_id || '","name":"ask","type":"call"}' as json,
       case when u.turn >= 2 and not exists (select 1 from users p where p.conv_id = u.conv_id and p.turn = u.turn - 2) then 'unknown need'
            when a.call_id is null then 'no result' when length(u.text) = 0 then '$.question: wrong length' when u.words not between 1 and 60 then '$.words: out of bounds' end as problem
from users u join ranked r using (conv_id, turn) left join answers a on a.call_id = u.call_id
union all
select a.conv_id, a.turn, r.level, 'result', a.call_id, '{"content":' || to_json(a.text) || ',"id":"' || a.call_id || '","type":"result"}',
       case when r.level is null then 'no call' end
from answers a left join ranked r on r.conv_id = a.conv_id and r.turn = a.turn - 1
union all
select conv_id, turn, null, 'message', null, '{"content":' || to_json(text) || ',"role":' || to_json(role) || ',"type":"message"}', null
from conversations where role not in ('user', 'assistant')
"""
