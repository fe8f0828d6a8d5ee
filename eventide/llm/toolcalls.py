"""Linking of tool calls and results, for chat formatting.

Calls and results meet in a hash join by (conversation, call id).  Calls are
ordered topologically: a call may name the call it comes after, and its level
is the length of that chain, found by pointer doubling (each round doubles the
distance that a pointer spans, so a chain of a million calls takes twenty
joins; what still points somewhere after that is a cycle).  Only calls whose
chain is not yet known take part in a further round.  Arguments are
parsed once and checked against the tool's schema, and every linked pair is
serialised as canonical JSON: keys sorted, no blanks.

All of it is DataFrame expressions.  No step gathers a conversation's rows:
keys are call ids, so a conversation of any size is spread over the cluster.

Defined results: of calls (results) with the same id in a conversation the
first by sequence counts, ``copies`` tells how many there were; a result
without a call is an orphan, a call without a result unanswered; null
conversation ids join each other, whatever the type of the ids; null call ids
never link; invalid or missing JSON is an error and serialised as null; very
long texts are kept whole; an empty table gives no rows; only the columns
named in ``link`` are read, so further ones cannot clash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import staged

#: Tools of the example protocol: field -> (type, required).
SCHEMAS = {
    "calculator": {"expression": ("STRING", True)},
    "lookup": {"depth": ("BIGINT", False), "key": ("STRING", True)},
    "search": {"limit": ("BIGINT", True), "query": ("STRING", True)},
}
NO_CONV = "none"


def events(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that a chat transcript stands for: each assistant turn
    is a call, the user turn after it the result; calls of the same eight turns
    come after each other.  Arguments follow from the turn's text, and some of
    them break the schema on purpose."""
    text = F.coalesce("text", F.lit(""))
    conv = F.coalesce(F.col("conv_id").cast("string"), F.lit(NO_CONV))

    def call(turn: Column) -> Column:
        return F.concat(F.lit("call_"), conv, F.lit("_"), turn.cast("string"))

    n = F.length(text)
    limit = F.when(n % 7 == 0, F.lit('"many"')).otherwise((n % 50).cast("string"))
    quoted = F.regexp_replace(F.substring(text, 1, 32), r"[^\p{L}\p{N} .,]", " ")
    search = F.concat(F.lit('{"query": "'), quoted, F.lit('", "limit": '), limit, F.lit("}"))
    lookup = F.when(n % 11 == 0, F.lit('{"depth": 1}')).otherwise(
        F.concat(F.lit('{"key": "'), conv, F.lit('", "depth": '), F.col("turn").cast("string"), F.lit("}"))
    )
    sums = F.concat(F.lit('{"expression": "'), n.cast("string"), F.lit("+"), F.col("turn").cast("string"), F.lit('"}'))
    kind = F.expr("turn div 2") % 3
    calls = conversations.where("role = 'assistant' and turn is not null").select(
        "conv_id",
        call(F.col("turn")).alias("call_id"),
        F.when(kind == 0, "search").when(kind == 1, "lookup").otherwise("calculator").alias("name"),
        F.when(kind == 0, search).when(kind == 1, lookup).otherwise(sums).alias("arguments"),
        F.when(F.col("turn") % 8 >= 2, call(F.col("turn") - 2)).alias("after"),
        F.col("turn").alias("seq"),
    )
    results = conversations.where("role = 'user' and turn >= 1").select(
        "conv_id", call(F.col("turn") - 1).alias("call_id"), text.alias("content"), F.col("turn").alias("seq")
    )
    return calls, results


def _first(rows: DataFrame) -> DataFrame:
    """The first row of each call id, with the number of its copies; copies
    are combined before they are shuffled."""
    rest = [c for c in rows.columns if c not in ("conv_id", "call_id")]
    best = F.min(F.struct("seq", *[c for c in rest if c != "seq"])).alias("x")
    found = rows.where("call_id is not null").groupBy("conv_id", "call_id").agg(best, F.count("*").alias("copies"))
    return found.select("conv_id", "call_id", *[F.col(f"x.{c}").alias(c) for c in rest], "copies")


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): length of the chain of calls before a call;
    -1 in a cycle.  A call after a missing one starts a chain."""
    ids = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("p"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("after") == F.col("p"))
    now = calls.select("conv_id", "call_id", "after").join(ids, same, "left")
    now = staged(now.select("conv_id", "call_id", F.col("p").alias("to"), F.col("p").isNotNull().cast("long").alias("level")), "toolcalls-levels")
    still, done = now.where("to is not null"), now.where("to is null")
    for _ in range(calls.count().bit_length()):  # pointers then span more calls than there are
        if still.isEmpty():
            break
        hop = done.unionByName(still).select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("to").alias("next"), F.col("level").alias("more"))
        step = still.join(hop, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("to") == F.col("i")), "left")
        new = step.select("conv_id", "call_id", F.col("next").alias("to"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level"))
        new = staged(new, "toolcalls-levels")
        still, done = new.where("to is not null"), done.unionByName(new.where("to is null"))
    return done.unionByName(still).select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("level")).otherwise(F.lit(-1)).alias("level"))


def argument_errors(name: Column, parsed: Column, keys: Column, schemas: dict) -> Column:
    """Array of what is wrong with parsed arguments, in a fixed order."""
    known = None
    for tool, fields in sorted(schemas.items()):
        found = []
        for f, (kind, required) in sorted(fields.items()):
            value = F.variant_get(parsed, f"$.{f}", "variant")
            there = F.array_contains(keys, f)
            wrong = F.when(there & (F.schema_of_variant(value) != kind), F.lit(f"{f}: not {kind.lower()}"))
            found.append(F.when(~there, F.lit(f"{f}: missing")).otherwise(wrong) if required else wrong)
        more = F.transform(F.array_except(keys, F.array(*map(F.lit, sorted(fields)))), lambda k: F.concat(k, F.lit(": unknown")))
        errors = F.concat(F.array_compact(F.array(*found)), F.sort_array(more))
        known = F.when(name == tool, errors) if known is None else known.when(name == tool, errors)
    errors = known.otherwise(F.array(F.concat(F.lit("no tool "), F.coalesce(name, F.lit("null")))))
    return F.when(keys.isNull(), F.array(F.lit("arguments: not a JSON object"))).otherwise(errors)


def link(calls: DataFrame, results: DataFrame, schemas: dict | None = None) -> DataFrame:
    """One row for each call id of ``calls(conv_id, call_id, name, arguments,
    after, seq)`` and ``results(conv_id, call_id, content, seq)``."""
    schemas = SCHEMAS if schemas is None else schemas
    calls = staged(_first(calls), "toolcalls-calls")
    order = levels(calls)
    left = calls.join(order.withColumnRenamed("conv_id", "c2"), (calls["call_id"] == order["call_id"]) & calls["conv_id"].eqNullSafe(F.col("c2"))).drop(order["call_id"]).drop("c2")
    left = left.select("conv_id", "call_id", "name", "arguments", "after", F.col("seq").alias("call_seq"), F.col("copies").alias("call_copies"), "level")
    right = _first(results).select(
        F.col("conv_id").alias("c3"), F.col("call_id").alias("i3"), "content", F.col("seq").alias("result_seq"), F.col("copies").alias("result_copies")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c3")) & (F.col("call_id") == F.col("i3"))
    both = left.join(right.hint("shuffle_hash"), same, "full")
    parsed = F.try_parse_json("arguments")
    keys = F.json_object_keys(F.when(parsed.isNotNull(), F.col("arguments")))
    both = both.select(
        F.when(F.col("call_id").isNull(), F.col("c3")).otherwise(F.col("conv_id")).alias("conv_id"), F.coalesce("call_id", "i3").alias("call_id"), "name", "arguments", "after", "call_seq", "call_copies",
        "level", "content", "result_seq", "result_copies", parsed.alias("parsed"), keys.alias("keys"),
    )
    status = F.when(F.col("name").isNull() & F.col("call_seq").isNull(), "orphan").when(F.col("result_seq").isNull(), "unanswered").otherwise("linked")
    errors = F.when(F.col("call_seq").isNull(), F.array().cast("array<string>")).otherwise(argument_errors(F.col("name"), F.col("parsed"), F.col("keys"), schemas))
    errors = F.concat(errors, F.when(F.col("level") == -1, F.array(F.lit("order: cycle"))).otherwise(F.array().cast("array<string>")))
    rows = both.withColumns({"status": status, "errors": errors})
    canonical = F.to_json(
        F.struct(
            F.when(F.col("keys").isNotNull(), F.col("parsed")).alias("arguments"), "call_id", F.col("content").alias("content"), "conv_id", "level", "name", "status"
        ),
        {"ignoreNullFields": "false"},
    )
    return rows.select(
        "conv_id", "call_id", "name", "status", "level", "call_seq", "result_seq", F.coalesce("call_copies", F.lit(0)).cast("long").alias("call_copies"),
        F.coalesce("result_copies", F.lit(0)).cast("long").alias("result_copies"), (F.size("errors") == 0).alias("valid"),
        F.array_join("errors", "; ").alias("errors"), canonical.alias("canonical"),
    )
