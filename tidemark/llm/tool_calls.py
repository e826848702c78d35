"""Tool-call linking for chat data, in Spark SQL expressions alone.

Calls and results are hash-joined by conversation and identifier, put in an order in which every call follows the calls it
refers to, checked against the tools' argument schemas, and written as canonical JSON (keys sorted, no blanks).

A call refers to another one of its conversation by the text ``$ref:<call id>`` anywhere in its arguments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import stable

REFERENCE = r"\$ref:([A-Za-z0-9_\-]+)"
#: Spark's variant types that satisfy a JSON schema type.
TYPES = {"string": "^STRING", "integer": "^BIGINT", "number": "^(BIGINT|DECIMAL|DOUBLE|FLOAT)", "boolean": "^BOOLEAN", "array": "^ARRAY", "object": "^OBJECT"}
KEYS = ["conv_id", "call_id"]


def _errors(schemas: dict[str, dict]) -> Column:
    """Argument errors of a call with columns ``name``, ``arguments`` and ``parsed``, sorted; none for valid arguments."""
    def of_tool(fields: dict) -> Column:
        keys = F.json_object_keys("arguments")
        found = [F.when(F.array_size(F.array_except(keys, F.lit(sorted(fields)))) > 0,
                        F.concat(F.lit("unknown "), F.array_join(F.array_sort(F.array_except(keys, F.lit(sorted(fields)))), " ")))]
        for field, rule in sorted(fields.items()):
            value = F.try_variant_get("parsed", f"$.{field}", "variant")
            there = F.array_contains(keys, field)
            if rule.get("required"):
                found.append(F.when(~there, f"missing {field}"))
            found.append(F.when(there & ~F.schema_of_variant(value).rlike(TYPES[rule["type"]]), f"type of {field}"))
            if "enum" in rule:
                text = F.try_variant_get("parsed", f"$.{field}", "string")
                found.append(F.when(there & ~F.coalesce(text.isin(rule["enum"]), F.lit(False)), f"value of {field}"))
        return F.array_sort(F.array_compact(F.array(*found)))

    shape = F.schema_of_variant("parsed")
    out = F.when(F.col("parsed").isNull(), F.array(F.lit("not JSON"))).when(~shape.startswith("OBJECT"), F.array(F.lit("not an object")))
    for tool, fields in schemas.items():
        out = out.when(F.col("name") == tool, of_tool(fields))
    return out.otherwise(F.array(F.lit("unknown tool")))


def _rounds(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, round) by peeling: round r holds the calls whose references all lie in earlier rounds; calls on or
    behind a circle get no row. Each round is a pair of anti-joins, checkpointed; the number of rounds is the longest chain of references."""
    rest, blocked = stable(calls.select(*KEYS)), stable(edges)
    done, number = None, 0
    while True:
        waiting = blocked.select("conv_id", F.col("child").alias("call_id")).distinct()
        ready = stable(rest.join(waiting, KEYS, "left_anti"))
        if ready.isEmpty():
            break
        peeled = ready.withColumn("round", F.lit(number))
        done = peeled if done is None else done.unionByName(peeled)
        rest = stable(rest.join(ready, KEYS, "left_anti"))
        blocked = stable(blocked.join(ready.withColumnRenamed("call_id", "parent"), ["conv_id", "parent"], "left_anti"))
        number += 1
    return done if done is not None else calls.select(*KEYS, F.lit(0).alias("round")).limit(0)


def call_order(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, round, missing_refs) for calls (conv_id, call_id, turn, refs), ids unique in a conversation.

    Sorting a conversation by (round, turn, call_id) puts every call behind those it refers to. Where all references of a conversation
    point back, turn order does that and every call is in round 0; only the other conversations are peeled round by round. A call on or
    behind a circle of references has a null round. References to no call of the conversation are listed, sorted, and do not bind.
    """
    links = calls.select("conv_id", F.col("call_id").alias("child"), F.col("turn").alias("child_turn"), F.explode("refs").alias("parent")).distinct()
    parents = calls.select("conv_id", F.col("call_id").alias("parent"), F.col("turn").alias("parent_turn"))
    links = stable(links.join(parents.withColumn("found", F.lit(True)), ["conv_id", "parent"], "left"))
    missing = links.where("found is null").groupBy("conv_id", F.col("child").alias("call_id")).agg(F.array_sort(F.collect_set("parent")).alias("missing_refs"))
    edges = links.where("found")
    back = F.struct("parent_turn", "parent") < F.struct("child_turn", "child")
    forward = stable(edges.where(~back).select("conv_id").distinct())
    peel = calls.join(forward, "conv_id", "left_semi")
    rounds = _rounds(peel, edges.join(forward, "conv_id", "left_semi").select("conv_id", "child", "parent"))
    marked = calls.join(forward.withColumn("peeled", F.lit(True)), "conv_id", "left").join(rounds, KEYS, "left")
    return (marked.withColumn("round", F.when(F.col("peeled"), F.col("round")).otherwise(0)).join(missing, KEYS, "left")
            .select(*KEYS, "round", F.coalesce("missing_refs", F.array().cast("array<string>")).alias("missing_refs")))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call id of a conversation, for calls (conv_id, turn, call_id, name, arguments) and results (conv_id, turn, call_id, content):

    conv_id, call_id, turn, name, status, n_calls, n_results, round, missing_refs, errors, valid, canonical.

    status: linked, pending (no result), early (the first result stands before the call), orphan (a result without a call). A repeated
    call id counts in ``n_calls`` and is the call of the smallest (turn, name, arguments); of several results the smallest (turn,
    content) is linked. ``schemas``: tool -> argument -> {type, required, enum}. ``canonical`` holds the call and its linked content as
    JSON with sorted keys; arguments that are no JSON stay text. Null call or conversation ids cannot be linked: each such row is a row of its own,
    pending or orphan. Null texts are JSON nulls; empty tables give no rows; other columns are not read.
    """
    with_id = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    call_row, result_row = F.struct("turn", "name", "arguments"), F.struct("turn", "content")
    calls, results = calls.select(*KEYS, call_row.alias("call")), results.select(*KEYS, result_row.alias("result"))
    one_call = calls.where(with_id).groupBy(*KEYS).agg(F.min("call").alias("call"), F.count("*").alias("n_calls"))
    one_result = results.where(with_id).groupBy(*KEYS).agg(F.min("result").alias("result"), F.count("*").alias("n_results"))
    linked = one_call.join(one_result, KEYS, "full")
    loose_calls = calls.where(~with_id).withColumn("n_calls", F.lit(1).cast("long"))
    loose_results = results.where(~with_id).withColumn("n_results", F.lit(1).cast("long"))
    rows = (linked.unionByName(loose_calls, allowMissingColumns=True).unionByName(loose_results, allowMissingColumns=True)
            .select(*KEYS, F.coalesce("call.turn", "result.turn").alias("turn"), "call.name", "call.arguments", "result.content",
                    F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
                    F.when(F.col("call").isNull(), "orphan").when(F.col("result").isNull(), "pending")
                    .when(F.col("result.turn") < F.col("call.turn"), "early").otherwise("linked").alias("status")))
    rows = stable(rows)
    own = rows.where(with_id & (F.col("n_calls") > 0))
    order = call_order(own.select(*KEYS, "turn", F.regexp_extract_all(F.coalesce("arguments", F.lit("")), F.lit(REFERENCE), F.lit(1)).alias("refs")))
    rows = rows.join(order, KEYS, "left").withColumn("parsed", F.try_parse_json("arguments"))
    errors = F.when(F.col("n_calls") > 0, _errors(schemas)).otherwise(F.array().cast("array<string>"))
    canonical = F.to_json(F.struct(
        F.coalesce(F.col("parsed"), F.to_variant_object(F.array("arguments"))).alias("arguments"), "call_id", "content", "name", "round", "status"), {"ignoreNullFields": "false"})
    return rows.withColumn("errors", errors).select(
        *KEYS, "turn", "name", "status", "n_calls", "n_results", "round", F.coalesce("missing_refs", F.array().cast("array<string>")).alias("missing_refs"),
        "errors", ((F.col("n_calls") > 0) & (F.size("errors") == 0)).alias("valid"), canonical.alias("canonical"))
