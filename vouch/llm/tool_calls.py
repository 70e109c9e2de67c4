"""Chat formatting: tool calls linked with their results, in order of dependency, as canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vouch.sources.staging import settle

TYPES = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
    "number": lambda v: isinstance(v, int | float) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "array": lambda v: isinstance(v, list),
    "object": lambda v: isinstance(v, dict),
    "null": lambda v: v is None,
}


def same(a: object, b: object) -> bool:
    """Whether two values are the same JSON: 1 and 1.0 are, 1 and true are not."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(same, a, b))
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(same(a[k], b[k]) for k in a)
    return a == b


def faults(value: object, schema: dict, at: str = "") -> list[str]:
    """What a value breaks of a JSON schema: type, enum, required, properties, items, bounds."""
    found = []
    kind = schema.get("type")
    if kind and not TYPES[kind](value):
        return [f"{at or '/'}: not {kind}"]
    if "enum" in schema and not any(same(value, known) for known in schema["enum"]):
        found.append(f"{at or '/'}: not in enum")
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        found.append(f"{at or '/'}: too short")
    if TYPES["number"](value) and not schema.get("minimum", value) <= value <= schema.get("maximum", value):
        found.append(f"{at or '/'}: out of bounds")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}/{k}: missing" for k in sorted(schema.get("required", ())) if k not in value]
        for k in sorted(value):
            if k in known:
                found += faults(value[k], known[k], f"{at}/{k}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}/{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        found += [x for k, v in enumerate(value) for x in faults(v, schema["items"], f"{at}/{k}")]
    return found


def canonical(value: object) -> str:
    """JSON with sorted keys, without blanks, text as it is."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def ordered(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """The calls with ``level``: 0, or in conversations where a call depends on a later one, its depth.

    ``edges``: conv_id, call_id, dep of dependencies on calls that exist, with ``forward``. Where
    every call depends on earlier ones their place is an order already, so only the other
    conversations go through rounds, a round per level: calls that wait for none leave, and
    what waited for them no longer does. Calls in a circle never leave and have no level.
    """
    late = settle(edges.where("forward").select("conv_id").distinct())
    if late.isEmpty():
        return calls.withColumn("level", F.lit(0))
    rest = settle(calls.join(late, "conv_id", "left_semi").select("conv_id", "call_id"))
    waits = settle(edges.join(late, "conv_id", "left_semi").select("conv_id", "call_id", "dep"))
    levels, level = None, 0
    while True:
        ready = settle(rest.join(waits, ["conv_id", "call_id"], "left_anti"))
        if ready.isEmpty():
            break
        reached = ready.withColumn("level", F.lit(level))
        levels = reached if levels is None else levels.unionAll(reached)
        rest = settle(rest.join(ready, ["conv_id", "call_id"], "left_anti"))
        waits = settle(waits.join(ready.select("conv_id", F.col("call_id").alias("dep")), ["conv_id", "dep"], "left_anti"))
        level += 1
    in_order = calls.join(late, "conv_id", "left_anti").withColumn("level", F.lit(0))
    if levels is None:
        levels = rest.where("false").withColumn("level", F.lit(0))
    return in_order.unionByName(calls.join(late, "conv_id", "left_semi").join(levels, ["conv_id", "call_id"], "left"))


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Every call with its result, and every result without a call.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), after (ids it depends on).
    ``results``: conv_id, turn, call_id, content. Columns: conv_id, call_id, turn, level, status,
    valid, faults, json. Within a conversation ``level``, ``turn``, ``call_id`` is an order in
    which every call follows those it depends on.

    Status: ``linked``; ``unanswered`` (no result); ``orphan`` (a result without call);
    ``circular`` (the call waits for itself). Repeated calls or results of an identifier count
    as the first by turn, then by content. Dependencies on unknown calls and arguments that are
    no JSON object or nested too deep to read, break the schema or name a tool without one are faults. Rows with a null
    conv_id or call_id have no identifier to link by and are left out. Both sides are reduced to
    a row per identifier before the join, so no identifier is a hot key, and no conversation is
    gathered in one task.
    """
    known = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    first_call = F.min(F.struct("turn", "name", "arguments", "after")).alias("c")
    first_result = F.min(F.struct("turn", "content")).alias("r")
    calls = settle(calls.where(known).groupBy("conv_id", "call_id").agg(first_call).select("conv_id", "call_id", "c.*"))
    results = results.where(known).groupBy("conv_id", "call_id").agg(first_result, F.lit(True).alias("answered"))
    deps = calls.select("conv_id", "call_id", "turn", F.explode("after").alias("dep"))
    places = calls.select("conv_id", F.col("call_id").alias("dep"), F.col("turn").alias("dep_turn"))
    edges = deps.join(places, ["conv_id", "dep"], "left")
    forward = ~(F.struct("dep_turn", "dep") < F.struct("turn", "call_id"))
    found = edges.where("dep_turn is not null").withColumn("forward", forward)
    unknown = edges.where("dep_turn is null").groupBy("conv_id", "call_id").agg(F.count("*").alias("unknown"))
    placed = ordered(calls, found).join(unknown, ["conv_id", "call_id"], "left")
    joined = placed.withColumn("called", F.lit(True)).join(results, ["conv_id", "call_id"], "full")
    status = (
        F.when(F.col("called").isNull(), "orphan")
        .when(F.col("level").isNull(), "circular")
        .when(F.col("answered").isNull(), "unanswered")
        .otherwise("linked")
    )
    rows = joined.select(
        "conv_id",
        "call_id",
        F.coalesce("turn", "r.turn").alias("turn"),
        "level",
        status.alias("status"),
        "name",
        "arguments",
        F.sort_array("after").alias("after"),
        F.coalesce("unknown", F.lit(0)).alias("unknown"),
        F.col("r.content").alias("content"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            broken, texts = [], []
            for row in batch.itertuples(index=False):
                found, arguments = ["/: unknown dependency"] * int(row.unknown), row.arguments
                if row.status != "orphan":
                    try:
                        arguments = json.loads(row.arguments or "")
                        canonical(arguments)
                        found += faults(arguments, schemas[row.name]) if row.name in schemas else ["/: no schema"]
                    except (ValueError, RecursionError):  # RecursionError: nested deeper than can be read
                        found, arguments = [*found, "/: not JSON"], row.arguments
                call = {"after": list(row.after) if row.after is not None else [], "arguments": arguments, "name": row.name}
                whole = {"id": row.call_id, "result": row.content, **(call if row.status != "orphan" else {})}
                broken.append(found)
                texts.append(canonical(whole))
            kept = batch[["conv_id", "call_id", "turn", "level", "status"]]
            yield kept.assign(valid=[not f for f in broken], faults=broken, json=texts)

    kinds = dict(rows.dtypes)
    head = ", ".join(f"{c} {kinds[c]}" for c in ("conv_id", "call_id", "turn", "level", "status"))
    return rows.mapInPandas(write, f"{head}, valid boolean, faults array<string>, json string")


REPLY = {
    "type": "object",
    "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
    "required": ["text", "turn"],
    "additionalProperties": False,
}


def from_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain chats: each user turn asks for a reply, the assistant's next turn is it.

    A call depends on the one two turns before, if there is one.
    """
    role = F.col("role")
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit(":"), turn.cast("string"))
    user = conversations.where(role == "user").select("conv_id", "turn", "text")
    asked = user.select(F.col("conv_id").alias("of"), (F.col("turn") + 2).alias("next")).distinct()
    before = user.join(asked, (F.col("conv_id") == F.col("of")) & (F.col("turn") == F.col("next")), "left")
    arguments = F.to_json(F.struct("text", "turn"), {"ignoreNullFields": "false"})
    after = F.when(F.col("next").isNotNull(), F.array(name(F.col("turn") - 2))).otherwise(F.array().cast("array<string>"))
    calls = before.select(
        "conv_id", "turn", name(F.col("turn")).alias("call_id"), F.lit("reply").alias("name"), arguments.alias("arguments"), after.alias("after")
    )
    replies = conversations.where(role == "assistant")
    results = replies.select("conv_id", "turn", name(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results


def messages(conversations: DataFrame) -> DataFrame:
    """A row, of status ``message``, for each turn that neither asks nor answers, in the columns of ``link``.

    These are turns of other roles than user and assistant, null included, and those without a conv_id
    or a turn, which nothing can be linked with. They have no call_id and no level.
    """

    @F.pandas_udf("string")
    def written(role: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([canonical({"content": t, "role": r}) for r, t in zip(role, text, strict=True)], dtype=object)

    linked = F.col("role").isin("user", "assistant") & F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    return conversations.where(~F.coalesce(linked, F.lit(False))).select(
        "conv_id",
        F.lit(None).cast("string").alias("call_id"),
        "turn",
        F.lit(None).cast("int").alias("level"),
        F.lit("message").alias("status"),
        F.lit(True).alias("valid"),
        F.array().cast("array<string>").alias("faults"),
        written("role", "text").alias("json"),
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """The calls of all conversations, linked, and all other turns as messages; see ``link``, ``from_turns``, ``messages``."""
    return link(*from_turns(conversations), {"reply": REPLY}).unionByName(messages(conversations))
