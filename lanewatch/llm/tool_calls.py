"""Chat formatting: link tool calls to their results, order, validate and serialise them.

Calls and results meet by hash join on conversation and identifier.  A call that names
other calls comes after them: its level is one more than the highest of theirs, found by doubling
the steps between calls.  Arguments are checked against the tool's schema, and each call with its result becomes
one line of canonical JSON.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from lanewatch.llm.common import written

_TYPES = {"object": dict, "array": list, "string": str, "boolean": bool}


def schema_errors(value, schema: dict, place: str = "$") -> list[str]:
    """What a value breaks of a JSON schema: type, enum, ranges, lengths, pattern, members."""
    kind = schema.get("type")
    if kind in ("integer", "number"):
        fits = isinstance(value, (int, float)) and not isinstance(value, bool) and (
            kind == "number" or isinstance(value, int) or value.is_integer())
    else:
        fits = value is None if kind == "null" else isinstance(value, _TYPES.get(kind, object))
    if not fits:
        return [f"{place}: not of type {kind}"]
    errors = []
    if "enum" in schema and value not in schema["enum"]:
        errors.append(f"{place}: not one of the listed values")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value):
            errors.append(f"{place}: below {schema['minimum']}")
        if value > schema.get("maximum", value):
            errors.append(f"{place}: above {schema['maximum']}")
    if isinstance(value, str):
        if not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
            errors.append(f"{place}: length {len(value)}")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            errors.append(f"{place}: does not match {schema['pattern']}")
    if isinstance(value, list) and "items" in schema:
        for k, item in enumerate(value):
            errors += schema_errors(item, schema["items"], f"{place}[{k}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        errors += [f"{place}.{name}: missing" for name in schema.get("required", ())
                   if name not in value]
        for name in sorted(value):
            if name in known:
                errors += schema_errors(value[name], known[name], f"{place}.{name}")
            elif schema.get("additionalProperties") is False:
                errors.append(f"{place}.{name}: unknown")
    return errors


def _whole_numbers(value):
    if isinstance(value, float) and value.is_integer() and abs(value) < 2**53:
        return int(value)
    if isinstance(value, list):
        return [_whole_numbers(v) for v in value]
    if isinstance(value, dict):
        return {k: _whole_numbers(v) for k, v in value.items()}
    return value


def _escaped(text: str) -> str:
    return re.sub("[\ud800-\udfff]", lambda half: f"\\u{ord(half.group()):04x}", text)


def canonical(value) -> str:
    """JSON with sorted names, no blanks, and whole numbers without a fraction.

    Halves of surrogate pairs, which no text can hold, stay escaped.
    """
    return _escaped(json.dumps(_whole_numbers(value), sort_keys=True, separators=(",", ":"),
                               ensure_ascii=False, allow_nan=False))


def _refused(constant: str):
    raise ValueError(constant)


def checked_arguments(name: str | None, text: str | None, schemas: dict[str, dict]):
    """Parsed arguments (None if they do not parse) and what is wrong with them."""
    try:
        value = json.loads(text or "", parse_constant=_refused)
        canonical(value)
    except (ValueError, RecursionError):
        return None, ["$: not JSON"]
    if name not in schemas:
        return value, ["$: unknown tool"]
    return value, [_escaped(error) for error in schema_errors(value, schemas[name])]


#: Steps are never counted beyond this: only cycles, which double them without end, reach it.
_FAR = 1 << 40


def dependency_levels(calls: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level)``: 0 without earlier calls, else one above the highest.

    ``calls`` has ``depends``, the identifiers a call waits for; unknown ones are ignored.
    Calls in or behind a cycle get no level and are absent.

    A wait says that its call comes at least so many steps after another.  In a round every
    wait for a call that has its level becomes a bound, and every wait for a call that itself
    waits for one call only is handed on to that one, with the steps of both.  So a chain
    takes rounds as the logarithm of its length; calls that wait for several others are
    passed one per round.  Waits are never more than at first, and each round is written.
    """
    keys = ["conv_id", "call_id"]
    known = written(calls.select(*keys).distinct(), "call-ids")
    waits = calls.select(*keys, F.explode("depends").alias("on")).distinct()
    waits = written(waits.join(known.withColumnRenamed("call_id", "on"), ["conv_id", "on"],
                               "left_semi").withColumn("steps", F.lit(1).cast("long")), "call-waits")

    def state(before: DataFrame, bounds: DataFrame) -> DataFrame:
        """A row per call: its level so far, its number of waits and, of a single one, what it is."""
        none = F.lit(None)
        rows = before.select(*keys, none.cast("string").alias("on"), none.cast("long").alias("steps"),
                             "level").unionByName(bounds)
        return written(rows.groupBy(*keys).agg(
            F.max("level").alias("level"), F.count("on").alias("n_waits"),
            F.max("on").alias("next"), F.max("steps").alias("next_steps")), "call-levels")

    def without_level(nodes: DataFrame) -> int:
        return nodes.where("n_waits > 0").count()

    nodes = state(known.withColumn("level", F.lit(0).cast("long")),
                  waits.withColumn("level", F.lit(0).cast("long")))
    left = without_level(nodes)
    while left:
        met = waits.join(nodes.select(
            "conv_id", F.col("call_id").alias("on"), "level", "n_waits", "next", "next_steps"),
            ["conv_id", "on"])
        bound = F.least(F.col("level") + F.col("steps"), F.lit(_FAR))
        bounds = written(met.select(
            *keys,
            F.when(F.col("n_waits") <= 1, F.col("next")).otherwise(F.col("on")).alias("on"),
            F.when(F.col("n_waits") == 0, F.lit(None)).when(
                F.col("n_waits") == 1, F.least(F.col("steps") + F.col("next_steps"), F.lit(_FAR)))
            .otherwise(F.col("steps")).alias("steps"),
            F.when(F.col("n_waits") <= 1, bound).otherwise(F.lit(0)).alias("level"),
        ).groupBy(*keys, "on").agg(
            F.max("steps").alias("steps"), F.max("level").alias("level")), "call-bounds")
        nodes = state(nodes, bounds)
        waits = bounds.where("on is not null").drop("level")
        before, left = left, without_level(nodes)
        if left == before:  # without a cycle, the earliest call left would have got its level
            break
    return nodes.where("n_waits = 0").select(*keys, F.col("level").cast("int").alias("level"))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call: its level, status, errors and canonical JSON, in order of work.

    ``calls``: conv_id, turn, call_id, name, arguments (text), depends (array of text).
    ``results``: conv_id, turn, call_id, content.  Of several results of a call the
    earliest counts (ties: smaller content) and ``n_results`` tells how many there were; results of no
    call are left out.  Calls that repeat an identifier: the earliest turn counts (ties:
    smaller name and arguments).  Null identifiers link with nothing and calls without
    one are left out.  ``status`` is, first that holds, ``cyclic``, ``invalid``, ``unanswered`` or
    ``linked``.  Rows are sorted by conversation, level, turn and identifier in one
    range exchange, so a long conversation may span tasks.
    """
    keys = ["conv_id", "call_id"]
    calls = written(
        calls.where("conv_id is not null and call_id is not null").groupBy(*keys)
        .agg(F.min(F.struct("turn", "name", "arguments", "depends")).alias("_c"))
        .select(*keys, "_c.*"), "calls")
    answers = results.where("call_id is not null").groupBy(*keys).agg(
        F.min(F.struct("turn", "content")).alias("_r"), F.count("*").alias("n_results"))
    levels = dependency_levels(calls)

    @F.pandas_udf(StructType().add("errors", StringType()).add("json", StringType()))
    def serialised(ids: pd.Series, names: pd.Series, arguments: pd.Series,
                   answered: pd.Series, contents: pd.Series) -> pd.DataFrame:
        rows = []
        for call, name, text, has, content in zip(ids, names, arguments, answered, contents):
            value, errors = checked_arguments(name, text, schemas)
            line = {"type": "tool_call", "id": call, "name": name, "arguments": value}
            if has:
                line["result"] = content
            rows.append(("; ".join(errors), canonical(line)))
        return pd.DataFrame(rows, columns=["errors", "json"])

    linked = calls.join(answers, keys, "left").join(levels, keys, "left")
    made = linked.withColumn("_s", serialised(
        "call_id", "name", "arguments", F.col("n_results").isNotNull(), "_r.content"))
    status = (
        F.when(F.col("level").isNull(), "cyclic").when(F.col("_s.errors") != "", "invalid")
        .when(F.col("n_results").isNull(), "unanswered").otherwise("linked"))
    return made.select(
        *keys, "turn", "level", status.alias("status"), F.col("_s.errors").alias("errors"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"),
        F.col("_s.json").alias("json"),
    ).orderBy("conv_id", "level", "turn", "call_id")


# --- calls and results that the ``conversations`` table gives ----------------------------------

SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"], "additionalProperties": False,
               "properties": {"query": {"type": "string", "minLength": 1},
                              "limit": {"type": "integer", "minimum": 0, "maximum": 400},
                              "after": {"type": "string"}}},
    "lookup": {"type": "object", "required": ["key"], "additionalProperties": False,
               "properties": {"key": {"type": "string", "pattern": "^[A-Z]"},
                              "limit": {"type": "integer"}, "after": {"type": "string"}}},
    "count": {"type": "object", "required": ["query", "limit"],
              "properties": {"limit": {"type": "number", "maximum": 2000},
                             "query": {"type": "string", "maxLength": 4000}}},
}


def calls_of(conversations: DataFrame) -> DataFrame:
    """Each assistant turn as a call about its whole text.

    It waits for the call two turns before, so that a chain of calls may run through a whole
    conversation; this is plain arithmetic, so the calls grow with the table.
    """
    turns = conversations.where("role = 'assistant'")
    name = F.element_at(F.array(*(F.lit(n) for n in sorted(SCHEMAS))),
                        (F.col("turn") % 3 + 1).cast("int"))
    call = F.concat(F.lit("call_"), F.col("turn").cast("string"))
    before = F.concat(F.lit("call_"), (F.col("turn") - 2).cast("string"))
    waits = F.col("turn") > 2
    text = F.coalesce(F.col("text"), F.lit(""))
    arguments = F.when(
        F.col("turn") % 3 == 1, F.to_json(F.struct(
            text.alias("key"), F.when(waits, before).alias("after")))).otherwise(
        F.to_json(F.struct(
            F.length(text).alias("limit"), text.alias("query"), F.when(waits, before).alias("after"))))
    return turns.select(
        "conv_id", "turn", call.alias("call_id"), name.alias("name"), arguments.alias("arguments"),
        F.when(waits, F.array(before)).otherwise(F.array().cast("array<string>")).alias("depends"))


def results_of(conversations: DataFrame) -> DataFrame:
    """Each user turn as the result of the call one turn before, if there is one."""
    return conversations.where("role = 'user'").select(
        "conv_id", "turn", F.concat(F.lit("call_"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        F.col("text").alias("content"))
