"""Links tool calls with their results and formats them.

Calls and results are summed up by their identifier before they are joined, so that repeats do not multiply.
A call may depend on others of its conversation; its level is one more than the highest of those it depends on, found
round by round over the calls that are still open. Conversations are never gathered: every call is a row
with its level, and its arguments are checked and written as canonical JSON in Arrow batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import settle

KINDS: dict[str, Callable[[Any], bool]] = {
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str),
    "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool) or isinstance(v, float) and v.is_integer(),
}


def canonical(value: Any) -> str:
    """JSON without blanks, with members in the order of their names' UTF-16 units and whole numbers without a point."""
    if isinstance(value, dict):
        items = sorted(value.items(), key=lambda kv: kv[0].encode("utf-16-be", "surrogatepass"))
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{canonical(v)}" for k, v in items) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, float) and value.is_integer() and abs(value) < 1e21:
        return str(int(value))
    return json.dumps(value, ensure_ascii=False, allow_nan=False)


def faults(value: Any, schema: Mapping[str, Any], at: str = "$") -> list[str]:
    """What in a value offends a JSON schema (type, enum, bounds, lengths, properties, items)."""
    kinds = schema.get("type")
    if kinds is not None and not any(KINDS[k](value) for k in ([kinds] if isinstance(kinds, str) else kinds)):
        return [f"{at}: not {kinds}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not in enum")
    if KINDS["number"](value):
        found += [f"{at}: below minimum"] if value < schema.get("minimum", value) else []
        found += [f"{at}: above maximum"] if value > schema.get("maximum", value) else []
    if isinstance(value, str):
        found += [f"{at}: too short"] if len(value) < schema.get("minLength", 0) else []
        found += [f"{at}: too long"] if len(value) > schema.get("maxLength", len(value)) else []
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            found += faults(v, schema["items"], f"{at}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        found += [f"{at}.{name}: missing" for name in schema.get("required", []) if name not in value]
        for name, v in value.items():
            if name in known:
                found += faults(v, known[name], f"{at}.{name}")
            elif schema.get("additionalProperties", True) is False:
                found.append(f"{at}.{name}: not expected")
    return found


def _refused(constant: str) -> float:
    raise ValueError(f"{constant} is not JSON")


def call_formatter(schemas: Mapping[str, Mapping[str, Any]]):
    """``valid, errors, json`` for rows of linked calls."""

    def formatted(name: str | None, arguments: str | None, call: str | None, result: str | None) -> tuple[bool, str, str]:
        try:
            value, found = json.loads(arguments or "{}", parse_constant=_refused), []
        except (ValueError, RecursionError):
            value, found = None, ["$: not JSON"]
        if not found:
            found = faults(value, schemas[name]) if name in schemas else [f"unknown tool {name}"]
        whole = {"arguments": arguments if value is None else value, "id": call, "name": name, "result": result}
        return not found, "; ".join(sorted(found)), canonical(whole)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inputs = [batch.column(c).to_pylist() for c in ("name", "arguments", "call_id", "result")]
            rows = [formatted(*row) for row in zip(*inputs)]
            columns = list(zip(*rows)) or [(), (), ()]
            keep = [i for i, n in enumerate(batch.schema.names) if n not in ("arguments", "result")]
            added = [pa.array(c, t) for c, t in zip(columns, (pa.bool_(), pa.string(), pa.string()))]
            names = [batch.schema.names[i] for i in keep] + ["valid", "errors", "json"]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *added], names=names)

    return run


def call_levels(calls: DataFrame) -> DataFrame:
    """``conv_id, call_id, level`` of calls with ``depends_on``: 0 without a known dependency, -1 on or behind a cycle.

    A call with one known dependency points to it; pointers are doubled until they reach a call with none or several (its
    head), so a chain of any length takes a logarithmic number of rounds. Only calls with several are then settled one
    after the other, by the heads of what they depend on.
    """
    key = ["conv_id", "call_id"]
    nodes = settle(calls.select(*key).distinct())
    edges = calls.select(*key, F.explode("depends_on").alias("parent")).distinct()
    parents = nodes.select(F.col("conv_id").alias("c"), F.col("call_id").alias("p"))
    edges = settle(edges.join(parents, (F.col("conv_id") == F.col("c")) & (F.col("parent") == F.col("p"))).select(*key, "parent"))
    counted = edges.groupBy(*key).agg(F.count("*").alias("n"), F.min("parent").alias("parent"))
    one = F.col("n") == 1
    ways = nodes.join(counted, key, "left").select(
        *key, F.coalesce("n", F.lit(0)).alias("n"), F.when(one, F.col("parent")).otherwise(F.col("call_id")).alias("head"),
        F.when(one, 1).otherwise(0).alias("far"), (~F.coalesce(one, F.lit(False))).alias("done"),
    )
    ways = settle(ways)
    longest = nodes.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length() + 1):  # what has not reached a head by then goes round in a circle
        if ways.where("NOT done").isEmpty():
            break
        ahead = ways.select(F.col("conv_id").alias("c"), F.col("call_id").alias("p"), F.col("head").alias("next"), F.col("far").alias("more"), F.col("done").alias("ends"))
        met = ways.where("NOT done").join(ahead, (F.col("conv_id") == F.col("c")) & (F.col("head") == F.col("p")))
        met = met.select(*key, "n", F.col("next").alias("head"), (F.col("far") + F.col("more")).alias("far"), F.col("ends").alias("done"))
        ways = settle(ways.where("done").unionByName(met))
    levels = settle(ways.where("n = 0").select(*key, F.lit(0).alias("level")))
    several = edges.join(ways.where("n > 1").select(*key), key)
    behind = ways.select(F.col("conv_id").alias("c"), F.col("call_id").alias("p"), F.when(F.col("done"), F.col("head")).alias("head"), "far")
    open_ = settle(several.join(behind, (F.col("conv_id") == F.col("c")) & (F.col("parent") == F.col("p"))).select(*key, "head", "far"))
    while not open_.isEmpty():
        known = levels.select("conv_id", F.col("call_id").alias("head"), "level")
        state = open_.join(known, ["conv_id", "head"], "left").groupBy(*key).agg(
            F.count("*").alias("n"), F.count("level").alias("known"), F.max(F.col("level") + F.col("far")).alias("most")
        )
        ready = settle(state.where("n = known").select(*key, (F.col("most") + 1).alias("level")))
        if ready.isEmpty():
            break
        levels = settle(levels.unionByName(ready))
        open_ = settle(open_.join(ready.select(*key), key, "left_anti"))
    heads = levels.select(F.col("conv_id").alias("c"), F.col("call_id").alias("p"), "level")
    reached = F.col("done") & F.col("level").isNotNull()
    found = ways.join(heads, (F.col("conv_id") == F.col("c")) & (F.col("head") == F.col("p")), "left")
    return found.select(*key, F.when(reached, F.col("level") + F.col("far")).otherwise(-1).cast("int").alias("level"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """One row per call: ``conv_id, turn, call_id, name, level, n_calls, n_results, valid, errors, json``.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON), depends_on (ids). ``results``: conv_id, call_id, content. Rows
    by (level, turn, call_id) are in topological order. A repeated call id is one call, the first by turn, name and
    arguments, with all dependencies; ``n_calls`` tells how many there were. Of several results the smallest text
    is taken, and ``n_results`` tells how many there were; without one the result is null. Calls without a
    conversation or an id, and results without a call, are linked with nothing and left out. Null or empty
    arguments are an empty object. Other columns are ignored. Empty tables give an empty result.
    """
    real = calls.where("conv_id IS NOT NULL AND call_id IS NOT NULL")
    first = F.min(F.struct("turn", "name", "arguments"))
    depends = F.array_distinct(F.flatten(F.collect_set(F.coalesce("depends_on", F.array().cast("array<string>")))))
    once = real.groupBy("conv_id", "call_id").agg(first.alias("call"), depends.alias("depends_on"), F.count("*").alias("n_calls"))
    once = settle(once.select("conv_id", "call_id", "call.*", "depends_on", "n_calls"))
    answers = results.groupBy("conv_id", "call_id").agg(F.min("content").alias("result"), F.count("*").alias("n_results"))
    linked = once.join(answers, ["conv_id", "call_id"], "left").join(call_levels(once), ["conv_id", "call_id"])
    linked = linked.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "call_id", "name", "level", "n_calls", F.coalesce("n_results", F.lit(0)).alias("n_results"), "arguments", "result"
    )
    kinds = dict(linked.dtypes)
    schema = f"conv_id {kinds['conv_id']}, turn long, call_id string, name string, level int, n_calls long, n_results long, valid boolean, errors string, json string"
    return linked.mapInArrow(call_formatter(schemas), schema)
