"""Chat formatting with tool-call linking.

Calls and results meet in a hash join on the call's identifier, which is unique on the side of
the calls, so no conversation is gathered in one place and a repeated call cannot multiply
results.  A call may name the call that it follows; pointer jumping over those names (each
round doubles the distance) gives every call its depth, and with it a topological order of
calls and results.  Arguments are validated against the tool's schema, and every message
becomes canonical JSON: keys sorted, no white space, no escapes that JSON does not need.

Status: call, result or message; orphan (a result without a call), unanswered (a call without a
result), duplicate (a further row with a call's identifier), cycle (calls that follow each
other), invalid (arguments that break the schema or are not JSON).

Defined results: nulls in text read as empty text; rows without an identifier, or of no kind or
another one, are messages of their own and come first; arguments that are nested too deeply to be read, or
hold half a surrogate pair or a number beyond doubles, are invalid and kept as a string; whole numbers may have any length; ties between rows with one identifier go by their JSON; an empty
table gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

import contextlib
import json
import math
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import cut, drop_table, hot_lookup

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


@contextlib.contextmanager
def _any_digits() -> Iterator[None]:
    """Whole numbers may have as many digits as there are."""
    most = sys.get_int_max_str_digits()
    sys.set_int_max_str_digits(0)
    try:
        yield
    finally:
        sys.set_int_max_str_digits(most)


def _double(digits: str) -> float:
    value = float(digits)
    if math.isinf(value):
        raise OverflowError(digits)
    return value


def violations(value, schema: dict, at: str = "$") -> list[str]:
    """What breaks a schema: type, enum, required, properties, additionalProperties, items and bounds."""
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    fits = lambda k: isinstance(value, _TYPES[k]) and not (isinstance(value, bool) and k in ("integer", "number"))
    if kinds and not any(map(fits, kinds)):
        return [f"{at}: not {'/'.join(kinds)}"]
    out = []
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{at}: not in enum")
    size = len(value) if isinstance(value, str | list) else value if isinstance(value, int | float) and not isinstance(value, bool) else None
    low, high = {str: ("minLength", "maxLength"), list: ("minItems", "maxItems")}.get(type(value), ("minimum", "maximum"))
    if size is not None and size < schema.get(low, size):
        out.append(f"{at}: under {low}")
    if size is not None and size > schema.get(high, size):
        out.append(f"{at}: over {high}")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            out += violations(x, schema["items"], f"{at}[{i}]")
    return out


def _serialise(schemas: dict[str, dict]):
    def rows(batches):
        for batch in batches:
            columns = {c: batch.column(c).to_pylist() for c in ("kind", "call_id", "name", "arguments", "content", "role")}
            out, errors = [], []
            for kind, call, name, arguments, content, role in zip(*columns.values(), strict=True):
                wrong = []
                if kind == "call":
                    try:
                        with _any_digits():
                            value = json.loads(arguments or "", parse_constant=lambda c: float("nan"), parse_float=_double)
                            canonical(value).encode()
                        wrong = [f"unknown tool {name}"] if name not in schemas else violations(value, schemas[name])
                    except RecursionError:
                        value, wrong = arguments, ["arguments are nested too deeply"]
                    except OverflowError:
                        value, wrong = arguments, ["a number is beyond doubles"]
                    except ValueError:  # also half a surrogate pair, which no UTF-8 text can hold
                        value, wrong = arguments, ["arguments are not JSON"]
                    message = {"role": "assistant", "tool_call": {"arguments": value, "id": call, "name": name}}
                elif kind == "result":
                    message = {"content": content or "", "role": "tool", "tool_call_id": call}
                else:
                    message = {"content": content or "", "role": role}
                with _any_digits():
                    out.append(canonical(message))
                errors.append("; ".join(wrong) or None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string()), pa.array(errors, pa.string())], [*batch.schema.names, "json", "errors"])

    return rows


def _depths(calls: DataFrame) -> DataFrame:
    """(call_id, depth) of calls (call_id, after); depth is null on a cycle and on what follows it."""
    known = calls.select(F.col("call_id").alias("after"), F.lit(True).alias("there"))
    start = calls.join(known, "after", "left").select("call_id", F.when(F.col("there"), F.col("after")).alias("jump"))
    now = cut(start.withColumn("depth", F.col("jump").isNotNull().cast("long")), "chat-depths")
    rounds = max(1, calls.count()).bit_length() + 1
    for _ in range(rounds):
        ahead = now.select(F.col("call_id").alias("jump"), F.col("jump").alias("next"), F.col("depth").alias("more"))
        step = now.join(ahead, "jump", "left").select("call_id", F.col("next").alias("jump"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"))
        old, now = now, cut(step, "chat-depths")
        drop_table(old)
        if now.where("jump is not null").isEmpty():
            break
    return now.select("call_id", F.when(F.col("jump").isNull(), F.col("depth")).alias("depth"))


#: Columns of the result besides those kept.
RESULT = ("call_id", "status", "position", "errors", "json")


def link(messages: DataFrame, schemas: dict[str, dict], keep: list[str]) -> DataFrame:
    """Per row of messages: the columns in keep, call_id, status, position, errors, json.

    messages has keep, kind (call, result or message), role, call_id, after (the identifier of
    the call that a call follows), name, arguments (JSON) and content.  position orders the
    rows of one chain of calls: 0 for messages, then each call before its result.  A column in keep
    with a name of RESULT comes back with kept_ before its name.
    """
    kept = F.struct(F.lit(None).cast("int").alias("none"), *(F.col(c).alias(f"keep{i}") for i, c in enumerate(keep))).alias("__keep")
    linked = F.col("call_id").isNotNull() & F.col("kind").isin("call", "result")
    rows = messages.select(kept, "kind", "role", "call_id", "after", "name", "arguments", "content").withColumn("kind", F.when(linked, F.col("kind")).otherwise("message"))
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    rows = cut(rows.mapInArrow(_serialise(schemas), f"{types}, json string, errors string"), "chat-rows")
    calls = rows.where("kind = 'call'").groupBy("call_id").agg(F.min(F.struct("json", "after")).alias("first"), F.count("*").alias("times"))
    calls = cut(calls.select("call_id", F.col("first.after").alias("after"), F.col("first.json").alias("first_json"), "times"), "chat-calls")
    answered = rows.where("kind = 'result'").select("call_id").distinct().withColumn("answered", F.lit(True))
    depths = _depths(calls.select("call_id", "after"))
    known = calls.join(depths, "call_id").join(answered, "call_id", "left").drop("after")
    uses = rows.where("call_id is not null").groupBy("call_id").agg(F.count("*").alias("uses"))  # also of those that no call has
    known = cut(uses.join(known, "call_id", "left"), "chat-known")
    out = cut(hot_lookup(rows, known, ["call_id"], "uses"), "chat-linked")
    for table in (rows, calls, depths, known):
        drop_table(table)
    status = (
        F.when(F.col("kind") == "message", "message")
        .when((F.col("kind") == "result") & F.col("times").isNull(), "orphan")
        .when(F.col("depth").isNull(), "cycle")
        .when((F.col("kind") == "call") & F.col("errors").isNotNull(), "invalid")
        .when((F.col("kind") == "call") & (F.col("json") != F.col("first_json")), "duplicate")
        .when((F.col("kind") == "call") & F.col("answered").isNull(), "unanswered")
        .otherwise(F.col("kind"))
    )
    position = F.when(F.col("kind") == "message", 0).otherwise(F.col("depth") * 2 + F.when(F.col("kind") == "call", 1).otherwise(2))
    named = (F.col(f"__keep.keep{i}").alias(f"kept_{c}" if c in RESULT else c) for i, c in enumerate(keep))
    return out.select(*named, "call_id", status.alias("status"), position.cast("long").alias("position"), "errors", "json")


#: Schema of the tool that a conversation's user turns are taken to call.
RESPOND = {"type": "object", "required": ["prompt", "turn"], "additionalProperties": False, "properties": {"prompt": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}}}


def from_turns(conversations: DataFrame) -> DataFrame:
    """Messages for link(): a user's turn calls the tool respond, the assistant's next turn is the result.

    The identifier of a call is conv_id-turn; it follows the call two turns before.
    """
    turn, conv = F.col("turn"), F.col("conv_id").cast("string")
    name = lambda back: F.concat_ws("-", conv, (turn - back).cast("string"))
    whole = turn.isNotNull() & conv.isNotNull()
    user, answer = (F.col("role") == "user") & whole, (F.col("role") == "assistant") & whole
    text = F.coalesce("text", F.lit(""))
    return conversations.select(
        "conv_id",
        "turn",
        F.col("role"),
        F.when(user, "call").when(answer, "result").otherwise("message").alias("kind"),
        F.when(user, name(0)).when(answer, name(1)).alias("call_id"),
        F.when(user, name(2)).alias("after"),
        F.when(user, "respond").alias("name"),
        F.when(user, F.to_json(F.struct(text.alias("prompt"), turn.alias("turn")))).alias("arguments"),
        text.alias("content"),
    )
