"""Tool calls of conversations, linked to their results, ordered, checked and written as canonical JSON.

Calls and results meet in a hash join on (conversation, identifier). Calls may refer to earlier calls of their
conversation. They are ordered topologically by two numbers, found in rounds of joins over all conversations at once, so
that a very long conversation is spread like any other rows: `stage` is the latest turn among a call and everything it
builds on, and `depth` counts the steps between calls of the same stage. Every call comes after those it refers to.
Where calls refer only to earlier turns one round settles both; more rounds are needed only for calls logged out of
order. Calls on a circle of references, and those that build on one, have no depth and come last.

Arguments are checked against JSON schemas (type, enum, const, properties, required, additionalProperties, items,
minimum, maximum, minLength, maxLength, minItems, maxItems, pattern).
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, functions as F

from .base import settle

#: Stands for a turn that is not given: after all others.
NO_TURN = 1 << 62

# Python types by the names of JSON schema.
KINDS = {
    "object": dict,
    "array": list,
    "string": str,
    "boolean": bool,
    "null": type(None),
    "integer": int,
    "number": (int, float),
}


def canonical(value) -> str:
    """JSON with sorted keys, no blanks, and whole numbers as integers."""

    def plain(x):
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        if isinstance(x, float) and x.is_integer() and abs(x) < 2**53:
            return int(x)
        return x

    return json.dumps(plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def violations(value, schema: dict, path: str = "$") -> list[str]:
    """What is wrong with a value under a schema, as "path: reason"."""
    out = []
    kinds = schema.get("type")
    if kinds is not None:
        kinds = [kinds] if isinstance(kinds, str) else kinds
        whole = isinstance(value, float) and value.is_integer() and "integer" in kinds
        good = any(isinstance(value, KINDS[k]) and not (isinstance(value, bool) and k in ("integer", "number")) for k in kinds)
        if not good and not whole:
            return [f"{path}: not {' or '.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not one of the allowed values")
    if "const" in schema and value != schema["const"]:
        out.append(f"{path}: not the constant")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if "minimum" in schema and value < schema["minimum"]:
            out.append(f"{path}: below {schema['minimum']}")
        if "maximum" in schema and value > schema["maximum"]:
            out.append(f"{path}: above {schema['maximum']}")
    if isinstance(value, str):
        if len(value) < schema.get("minLength", 0):
            out.append(f"{path}: shorter than {schema['minLength']}")
        if len(value) > schema.get("maxLength", len(value)):
            out.append(f"{path}: longer than {schema['maxLength']}")
        if "pattern" in schema and not re.search(schema["pattern"], value):
            out.append(f"{path}: does not match")
    if isinstance(value, list):
        if not schema.get("minItems", 0) <= len(value) <= schema.get("maxItems", len(value)):
            out.append(f"{path}: wrong number of items")
        for i, item in enumerate(value):
            out += violations(item, schema.get("items", {}), f"{path}[{i}]")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{name}: missing" for name in sorted(schema.get("required", [])) if name not in value]
        for name in sorted(value):
            if name in known:
                out += violations(value[name], known[name], f"{path}.{name}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{name}: unknown")
    return out


def check(name: str | None, arguments: str | None, schemas: dict[str, dict]) -> tuple[str | None, list[str]]:
    """The arguments as canonical JSON, null if they are no JSON, and what is wrong with them."""
    if name not in schemas:
        found = ["unknown tool"]
    else:
        found = []
    try:
        value = json.loads("" if arguments is None else arguments)
        text = canonical(value)
    except (ValueError, RecursionError):
        return None, [*found, "arguments are not JSON"]
    return text, found or violations(value, schemas[name])


def _identity(scope: str, id_: str) -> Column:
    """Conversation and identifier in one text; null for a null identifier, a null conversation is like an empty one."""
    return F.concat(F.coalesce(F.col(scope).cast("string"), F.lit("")), F.lit("\u0000"), F.col(id_).cast("string"))


def ordered(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """`node`, `stage` and `depth` of nodes (node, turn) under edges (node, parent) between them.

    Both are read from written tables; nodes are distinct. Nodes on or behind a circle have a null depth.
    """
    nodes = nodes.select("node", F.coalesce("turn", F.lit(NO_TURN)).cast("long").alias("stage"))
    while True:
        above = nodes.select(F.col("node").alias("parent"), F.col("stage").alias("above"))
        raised = edges.join(above, "parent").groupBy("node").agg(F.max("above").alias("above"))
        joined = settle(nodes.join(raised, "node", "left"))
        nodes = settle(joined.select("node", F.greatest("stage", F.coalesce("above", "stage")).alias("stage")))
        if joined.where("above > stage").isEmpty():
            break
    ends = nodes.select(F.col("node").alias("parent"), F.col("stage").alias("above"))
    tied = settle(edges.join(nodes, "node").join(ends, "parent").where("stage = above").select("node", "parent"))
    placed, depth = [], 0
    left = nodes
    while not tied.isEmpty():  # take away the nodes that wait for none of the same stage
        waiting = tied.select("node").distinct()
        placed.append(settle(left.join(waiting, "node", "left_anti").withColumn("depth", F.lit(depth))))
        if placed[-1].isEmpty():
            placed[-1] = left.withColumn("depth", F.lit(None).cast("int"))
            break
        left = settle(left.join(waiting, "node", "left_semi"))
        gone = placed[-1].select(F.col("node").alias("parent"))
        tied = settle(tied.join(gone, "parent", "left_anti"))
        depth += 1
    else:
        placed.append(left.withColumn("depth", F.lit(depth)))
    out = placed[0]
    for part in placed[1:]:
        out = out.unionByName(part)
    out = settle(out)
    lost = fresh = settle(out.where("depth IS NULL").select(F.col("node").alias("parent")))
    while not fresh.isEmpty():  # what builds on a circle in a later stage is lost as well
        behind = edges.join(fresh, "parent").select("node").distinct().select(F.col("node").alias("parent"))
        fresh = settle(behind.join(lost, "parent", "left_anti"))
        lost = settle(lost.unionByName(fresh))
    lost = lost.select(F.col("parent").alias("_lost"))
    return out.join(lost, F.col("node") == F.col("_lost"), "left").select(
        "node", "stage", F.when(F.col("_lost").isNull(), F.col("depth")).alias("depth")
    )


def _first(rows: DataFrame, node: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Of every node the smallest value and the number of rows, and all other rows, equal ones as often as they occur.

    Equal rows are counted before anything is joined, and both sides of the join are read from tables, so that one node
    may hold most rows.
    """
    counted = settle(rows.groupBy(node, value).agg(F.count("*").alias("n")))
    first = settle(counted.groupBy(node).agg(F.min(value).alias(value), F.sum("n").alias("copies")))
    least = first.select(F.col(node).alias("_node"), F.col(value).alias("_least"))
    joined = counted.join(least, F.col(node) == F.col("_node"))
    more = F.col("n") - F.when(F.col(value).eqNullSafe(F.col("_least")), 1).otherwise(0)
    others = joined.withColumn("_again", F.explode(F.array_repeat(F.lit(1), more.cast("int"))))
    return first, others.select(node, value)


def link(calls: DataFrame, results: DataFrame, schemas: dict[str, dict], scope: str = "conv_id") -> DataFrame:
    """Every call with its result, every result without a call, and every repeated row.

    `calls` has the scope, `turn`, `call_id`, `name`, `arguments` (JSON text) and `refers` (array of call ids);
    `results` has the scope, `turn`, `call_id` and `content`. Of several calls or results with one identifier the first
    is linked, by turn and then by content; each of the others is a row of its own, with the identifier that it repeats.
    Returned are the scope, `call_id`, `turn`, `stage`, `depth`, `status`, `errors`, `copies` (calls with that
    identifier) and the canonical JSON `call` and `result`, null where there is none. Sorted by stage, depth and call_id,
    a conversation is in topological order. Other columns are not carried along. Null scopes are one conversation.

    Status, the first that fits: "orphan" (a result without a call), "unnamed" (a call without an identifier), "circular",
    "dangling" (refers to a call that is not there), "invalid" (arguments), "open" (no result), "linked"; and "repeated" (a
    later call or result with an identifier that has one), without stage and depth.
    """
    call = F.struct("turn", "name", "arguments", "refers", F.col(scope).alias("scope"), F.col("call_id").alias("id"))
    told = calls.select(_identity(scope, "call_id").alias("node"), call.alias("c"))
    named, called_again = _first(told.where("node IS NOT NULL"), "node", "c")
    unnamed = told.where("node IS NULL").select(F.lit(None).cast("string").alias("node"), "c", F.lit(1).cast("long").alias("copies"))

    links = named.select("node", F.explode(F.array_distinct("c.refers")).alias("ref"), "c.scope")
    links = settle(links.select("node", _identity("scope", "ref").alias("parent")).where("parent IS NOT NULL"))
    present = named.select(F.col("node").alias("parent"))
    edges = settle(links.join(present, "parent", "left_semi"))
    dangling = settle(links.join(present, "parent", "left_anti").select(F.col("node").alias("broken")).distinct())
    places = settle(ordered(named.select("node", "c.turn"), edges))

    answer = F.struct("turn", "content", F.col(scope).alias("scope"), F.col("call_id").alias("id"))
    given = results.select(_identity(scope, "call_id").alias("answered"), answer.alias("r"))
    nameless = given.where("answered IS NULL")
    answered, answered_again = _first(given.where("answered IS NOT NULL"), "answered", "r")
    given = answered.drop("copies").unionByName(nameless)

    joined = (
        named.unionByName(unnamed)
        .join(places, "node", "left")
        .join(dangling, F.col("node") == F.col("broken"), "left")
        .join(given.hint("shuffle_hash"), F.col("node") == F.col("answered"), "full_outer")
        .withColumn("again", F.lit(False))
    )
    for repeated in (called_again, answered_again):
        joined = joined.unionByName(repeated.withColumn("again", F.lit(True)), allowMissingColumns=True)

    @F.pandas_udf("call string, errors array<string>")
    def checked(names, arguments, ids, refers):
        import pandas as pd

        rows = []
        for name, text, id_, refs in zip(names, arguments, ids, refers, strict=True):
            body, wrong = check(name, text, schemas)
            whole = {"id": id_, "name": name, "arguments": None if body is None else json.loads(body)}
            if refs is not None and len(refs):
                whole["after"] = sorted(r for r in refs if r is not None)
            rows.append((canonical(whole), wrong))
        return pd.DataFrame(rows, columns=["call", "errors"])

    @F.pandas_udf("string")
    def spoken(ids, contents):
        return type(ids)([canonical({"id": i, "content": c}) for i, c in zip(ids, contents, strict=True)])

    is_call, has_result = F.col("c").isNotNull(), F.col("r").isNotNull()
    rows = joined.select(
        "*",
        F.when(is_call, checked("c.name", "c.arguments", "c.id", "c.refers")).alias("checked"),
        F.when(has_result, spoken("r.id", "r.content")).alias("result"),
    )
    status = (
        F.when(F.col("again"), "repeated")
        .when(~is_call, "orphan")
        .when(F.col("node").isNull(), "unnamed")
        .when(F.col("depth").isNull(), "circular")
        .when(F.col("broken").isNotNull(), "dangling")
        .when(F.size("checked.errors") > 0, "invalid")
        .when(~has_result, "open")
        .otherwise("linked")
    )
    return rows.select(
        F.coalesce("c.scope", "r.scope").alias(scope),
        F.coalesce("c.id", "r.id").alias("call_id"),
        F.when(is_call, F.col("c.turn")).otherwise(F.col("r.turn")).alias("turn"),
        "stage",
        "depth",
        status.alias("status"),
        F.array_join("checked.errors", "; ").alias("errors"),
        F.coalesce("copies", F.lit(0).cast("long")).alias("copies"),
        F.col("checked.call").alias("call"),
        "result",
    )
