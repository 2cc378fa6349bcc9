"""Tool calls of conversations: linked, ordered, validated and serialised.

Calls and results meet in a hash join by identifier. The order puts every call
behind those whose results it needs: calls without needs are level 0, others one
more than the highest level they need. Each round settles one level, so rounds are
as many as the longest chain of needs; calls that a round cannot settle any more
need each other. Arguments are checked against the JSON schema of their tool, and
messages are written as canonical JSON.
"""

import json
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtstats.sources.shared import stage

TYPES = {
    "string": str, "boolean": bool, "array": list, "object": dict, "null": type(None),
    "integer": int, "number": (int, float),
}
KEYS = ["conv_id", "call_id"]


def _once(pairs):
    names = [k for k, _ in pairs]
    if len(set(names)) < len(names):
        raise ValueError("a name stands twice in an object")
    return dict(pairs)


def _refuse(name):
    raise ValueError(f"{name} is not JSON")


def parse(text):
    """The value of a JSON text; raises ValueError for anything not strictly JSON."""
    try:
        value = json.loads(text, object_pairs_hook=_once, parse_constant=_refuse)
        canonical(value).encode("utf-8")
    except RecursionError as error:
        raise ValueError("the text is nested too deeply") from error
    return value


def canonical(value):
    """JSON with sorted names, no blanks, whole numbers without a fraction."""

    def plain(x):
        if isinstance(x, float):
            if not math.isfinite(x):
                raise ValueError("a number is too large")
            return int(x) if x == int(x) and abs(x) < 2**53 else x
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


#: Keywords that say nothing about a value.
NOTES = {"title", "description", "default", "examples", "$schema", "$id", "$comment"}
RULES = {
    "type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
    "minLength", "maxLength", "pattern", "minItems", "maxItems", "items", "properties",
    "required", "additionalProperties", "anyOf",
}


def check_schema(schema):
    """Raise ValueError for a schema with a keyword or type that is not known here."""
    if not isinstance(schema, dict):
        raise ValueError(f"{schema!r} is not an object")
    if unknown := set(schema) - RULES - NOTES:
        raise ValueError(f"unknown schema keywords: {', '.join(sorted(unknown))}")
    if unknown := set(_types(schema)) - set(TYPES):
        raise ValueError(f"unknown types: {', '.join(sorted(map(str, unknown)))}")
    if not isinstance(schema.get("additionalProperties", False), bool):
        raise ValueError("additionalProperties must be true or false")
    re.compile(schema.get("pattern", ""))
    parts = [*schema.get("properties", {}).values(), *schema.get("anyOf", [])]
    for part in [*parts, *([schema["items"]] if "items" in schema else [])]:
        check_schema(part)


def _types(schema):
    wanted = schema.get("type", [])
    return wanted if isinstance(wanted, list) else [wanted]


def _is_of(value, kind):
    return isinstance(value, TYPES[kind]) and not (
        isinstance(value, bool) and kind in ("integer", "number")
    )


def violations(value, schema, at="arguments"):
    """What is wrong with a value under a schema, type first.

    Known keywords are those in ``RULES``; an integer is a number without fraction
    part, written as one. Values are the same if their canonical JSON is.
    """
    wanted = _types(schema)
    if wanted and not any(_is_of(value, kind) for kind in wanted):
        return [f"{at} is not of type {' or '.join(wanted)}"]
    found = []

    def rule(name, holds, text):
        if name in schema and not holds(schema[name]):
            found.append(f"{at} is {text}")

    rule("enum", lambda some: canonical(value) in map(canonical, some), "none of the values")
    rule("const", lambda one: canonical(value) == canonical(one), "not the value")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        rule("minimum", lambda least: value >= least, "too small")
        rule("exclusiveMinimum", lambda least: value > least, "too small")
        rule("maximum", lambda most: value <= most, "too large")
        rule("exclusiveMaximum", lambda most: value < most, "too large")
    if isinstance(value, str):
        rule("minLength", lambda least: len(value) >= least, "too short")
        rule("maxLength", lambda most: len(value) <= most, "too long")
        rule("pattern", lambda text: re.search(text, value), "not of the pattern")
    if isinstance(value, list):
        rule("minItems", lambda least: len(value) >= least, "too short")
        rule("maxItems", lambda most: len(value) <= most, "too long")
        for i, x in enumerate(value):
            found += violations(x, schema.get("items", {}), f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{k} is missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                found += violations(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties") is False:
                found.append(f"{at}.{k} is unknown")
    rule("anyOf", lambda some: any(not violations(value, x, at) for x in some), "of none of the forms")
    return found


def levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of all calls that can be ordered."""
    nodes = stage(calls.select(*KEYS).where("call_id is not null").distinct(), "nodes")
    edges = needs.join(nodes.toDF("conv_id", "need"), ["conv_id", "need"]).distinct()
    edges = stage(edges.select(*KEYS, "need"), "edges")
    counts = edges.groupBy(*KEYS).agg(F.count("*").alias("wanted"))
    newest = stage(
        nodes.join(counts, KEYS, "left_anti").withColumn("level", F.lit(0)), "level"
    )
    settled, open_ = newest, stage(counts.withColumn("high", F.lit(-1)), "open")
    while not newest.isEmpty():
        below = newest.select("conv_id", F.col("call_id").alias("need"), "level")
        met = edges.join(below, ["conv_id", "need"]).groupBy(*KEYS).agg(
            F.count("*").alias("met"), F.max("level").alias("reached")
        )
        open_ = stage(
            open_.join(met, KEYS, "left").select(
                *KEYS,
                (F.col("wanted") - F.coalesce("met", F.lit(0))).alias("wanted"),
                F.greatest("high", F.coalesce("reached", F.lit(-1))).alias("high"),
            ),
            "open",
        )
        newest = open_.where("wanted = 0").select(*KEYS, (F.col("high") + 1).alias("level"))
        settled = settled.unionByName(newest)
        open_ = open_.where("wanted > 0")
    return settled


def _written(schemas):
    def run(batches):
        for batch in batches:
            out = [[], [], []]
            for row in batch.to_pylist():
                value, wrong = None, []
                if row["status"] != "orphan":
                    schema = schemas.get(row["name"])
                    try:
                        value = parse(row["arguments"] or "")
                    except ValueError:
                        wrong.append("arguments are not JSON")
                    if schema is None:
                        wrong.append("the tool is unknown")
                    elif not wrong:
                        wrong += violations(value, schema)
                message = {
                    "id": row["call_id"],
                    "level": row["level"],
                    "name": row["name"],
                    "arguments": value if not wrong else row["arguments"],
                    "result": row["content"],
                    "status": row["status"],
                    "valid": not wrong and row["status"] == "answered",
                }
                out[0].append(message["valid"])
                out[1].append(wrong)
                out[2].append(canonical(message))
            keep = [batch.column(c) for c in ("conv_id", "turn", "call_id", "name", "level", "status")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(out[0], pa.bool_()), pa.array(out[1], pa.list_(pa.string())), pa.array(out[2], pa.string())],
                ["conv_id", "turn", "call_id", "name", "level", "status", "valid", "errors", "message"],
            )

    return run


def tool_messages(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row for each call, and for each identifier with results but no call.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON), needs (identifiers in
    the same conversation). ``results``: conv_id, turn, call_id, content. Returns
    ``conv_id, turn, call_id, name, level, status, valid, errors, message``; ordered
    by (level, turn, call_id) every call of a conversation stands behind what it
    needs. ``status``: answered, unanswered, cycle (the call needs itself, in some
    steps), or orphan (results without a call). Of several results the earliest
    counts; calls that are repeated as a whole count once; needed identifiers without
    a call are passed over. A null identifier or conversation links with nothing.
    Empty tables give no rows; texts are kept whole, however long. A schema with a
    keyword that is not in ``RULES`` raises.
    """
    for schema in schemas.values():
        check_schema(schema)
    calls = stage(
        calls.select(*KEYS, "turn", "name", "arguments", "needs").distinct(), "calls"
    )
    answers = results.groupBy(*KEYS).agg(F.min(F.struct("turn", "content")).alias("answer"))
    needs = calls.select(*KEYS, F.explode("needs").alias("need"))
    known = levels(calls.where("conv_id is not null"), needs)
    linked = (
        calls.join(answers.hint("shuffle_hash"), KEYS, "left")
        .join(known, KEYS, "left")
        .select(
            *KEYS,
            "turn",
            "name",
            "arguments",
            F.coalesce("level", F.when(F.col("call_id").isNull() | F.col("conv_id").isNull(), 0)).alias("level"),
            "answer",
        )
    )
    status = (
        F.when(F.col("level").isNull(), "cycle")
        .when(F.col("answer").isNull(), "unanswered")
        .otherwise("answered")
    )
    content = F.col("answer.content")
    linked = linked.select(
        *KEYS, "turn", "name", "arguments", "level", status.alias("status"), content.alias("content")
    )
    none = F.lit(None)
    orphans = answers.join(calls.select(*KEYS).distinct(), KEYS, "left_anti").select(
        *KEYS,
        F.col("answer.turn").alias("turn"),
        none.cast("string").alias("name"),
        none.cast("string").alias("arguments"),
        none.cast("int").alias("level"),
        F.lit("orphan").alias("status"),
        content.alias("content"),
    )
    return linked.unionByName(orphans).mapInArrow(
        _written(schemas),
        "conv_id bigint, turn bigint, call_id string, name string, level int, status string,"
        " valid boolean, errors array<string>, message string",
    )


#: The tools of the calls that are derived from conversations.
SCHEMAS = {
    "search": {
        "type": "object",
        "properties": {
            "query": {"type": "string", "maxLength": 2000},
            "limit": {"type": "integer", "minimum": 1, "maximum": 50},
        },
        "required": ["query", "limit"],
        "additionalProperties": False,
    },
    "translate": {
        "type": "object",
        "properties": {
            "query": {"type": "string"},
            "limit": {"type": "integer"},
            "to": {"type": "string", "enum": ["en", "de", "fr", "es"]},
        },
        "required": ["query", "to"],
    },
}


def derived_traffic(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results read out of plain conversations (conv_id, turn, role, text).

    A user turn is a call: a tool and a limit chosen by the checksum of its text,
    which is its query. It needs the call two turns before if the checksum is even.
    An assistant turn is the result of the user turn before it.
    """
    text = F.coalesce("text", F.lit(""))
    number = F.crc32(text.cast("binary"))
    identifier = lambda turn: F.concat(F.lit("call_"), turn.cast("string"))
    search = F.pmod(number, F.lit(3)) > 0
    limit = F.pmod(number, F.lit(60)).cast("int")
    calls = conversations.where("role = 'user'").select(
        "conv_id",
        "turn",
        identifier(F.col("turn")).alias("call_id"),
        F.when(search, "search").otherwise("translate").alias("name"),
        F.when(search, F.to_json(F.struct(text.alias("query"), limit.alias("limit"))))
        .otherwise(F.to_json(F.struct(F.lit("en").alias("to"), text.alias("query"))))
        .alias("arguments"),
        F.when(F.pmod(number, F.lit(2)) == 0, F.array(identifier(F.col("turn") - 2)))
        .otherwise(F.array().cast("array<string>"))
        .alias("needs"),
    )
    results = conversations.where("role = 'assistant'").select(
        "conv_id", "turn", identifier(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content")
    )
    return calls, results
