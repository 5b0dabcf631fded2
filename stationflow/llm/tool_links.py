"""Chat formatting: tool calls linked with their results, ordered, validated and serialised, in DataFrame functions alone.

Calls and results meet in a hash join by conversation and call identifier, after each side is reduced to one row for each
identifier, so no key is hot there. A call may name the call it comes after. Its depth, by which calls are in topological
order, comes from pointer doubling: each round follows twice as many links, so long conversations take few rounds.
Arguments are checked against the tools' schemas, and every record is written as JSON with sorted keys and no spaces.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.llm.common import stored

#: Names that Spark's variants give to the types of JSON Schema.
TYPES = {
    "string": r"^STRING$", "integer": r"^(BIGINT|DECIMAL\([0-9]+,0\))$", "number": r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$",
    "boolean": r"^BOOLEAN$", "array": r"^ARRAY", "object": r"^OBJECT",
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = True


@dataclass(frozen=True)
class Tool:
    name: str
    fields: tuple[Field, ...]


def problems(name: Column, arguments: Column, tools: list[Tool]) -> Column:
    """What is wrong with a call's arguments, as an array of texts."""
    value, keys = F.try_parse_json(arguments), F.json_object_keys(arguments)
    none = F.array().cast("array<string>")
    out = F.array(F.lit("unknown tool"))
    for tool in tools:
        found = []
        for field in tool.fields:
            kind = F.schema_of_variant(F.try_variant_get(value, f"$['{field.name}']", "variant"))
            given = F.array_contains(keys, field.name)
            missing = F.lit(f"missing {field.name}") if field.required else F.lit(None).cast("string")
            found.append(F.when(~given, missing).when(~kind.rlike(TYPES[field.type]), F.lit(f"type of {field.name}")))
        known = F.array(*[F.lit(f.name) for f in tool.fields]) if tool.fields else none
        odd = F.transform(F.array_sort(F.array_except(keys, known)), lambda k: F.concat(F.lit("unexpected "), k))
        listed = F.concat(F.array_compact(F.array(*found)), odd) if found else odd
        out = F.when(name == tool.name, listed).otherwise(out)
    # An object that repeats a key is no valid object either.
    return F.when(value.isNull() | keys.isNull(), F.array(F.lit("not a JSON object"))).otherwise(out)


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth: how many calls come before along `after`; null where the links run in a circle.

    A call whose predecessor isn't there begins a chain.
    """
    key = ["conv_id", "call_id"]
    there = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    first = calls.join(there, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("after") == F.col("i")), "left")
    links = stored(first.select(*key, F.col("i").alias("up"), F.col("i").isNotNull().cast("long").alias("depth")), "links")
    n = links.count()
    for _ in range(math.ceil(math.log2(n + 1)) + 1 if n else 0):
        far = links.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("up").alias("next"), F.col("depth").alias("more"))
        met = links.join(far, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("i")), "left")
        links = stored(met.select(*key, F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "links")
        if links.where("up is not null").isEmpty():
            break
    return links.select(*key, F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def link(calls: DataFrame, results: DataFrame, tools: list[Tool]) -> DataFrame:
    """One row for each identifier of calls (conv_id, call_id, turn, name, arguments, after) or results (conv_id, call_id,
    turn, content): status linked, no_result or no_call, and the record as canonical JSON.

    Of rows that repeat an identifier the first by turn counts (ties: by the other columns); n_calls and n_results tell how
    many there were. Rows without call_id can't be linked and are left out; a null conv_id is a conversation of its own.
    Rows of a conversation in the order of depth, then turn, are in topological order.
    """
    key = ["conv_id", "call_id"]
    once = stored(
        calls.where("call_id is not null").groupBy(*key).agg(F.count("*").alias("n_calls"), F.min(F.struct("turn", "name", "arguments", "after")).alias("call")).select(*key, "n_calls", "call.*"),
        "calls",
    )
    answers = results.where("call_id is not null").groupBy(*key).agg(F.count("*").alias("n_results"), F.min(F.struct("turn", "content")).alias("answer"))
    answers = answers.select(F.col("conv_id").alias("r_conv"), F.col("call_id").alias("r_call"), "n_results", F.col("answer.turn").alias("r_turn"), F.col("answer.content").alias("content"))
    depth = depths(once).select(F.col("conv_id").alias("d_conv"), F.col("call_id").alias("d_call"), "depth")
    ordered = once.join(depth, F.col("conv_id").eqNullSafe(F.col("d_conv")) & (F.col("call_id") == F.col("d_call")), "left")
    met = ordered.join(answers, F.col("conv_id").eqNullSafe(F.col("r_conv")) & (F.col("call_id") == F.col("r_call")), "full")
    called, answered = F.col("n_calls").isNotNull(), F.col("n_results").isNotNull()
    rows = met.select(
        F.coalesce("conv_id", "r_conv").alias("conv_id"),
        F.coalesce("call_id", "r_call").alias("call_id"),
        F.coalesce("turn", "r_turn").alias("turn"),
        "name",
        "arguments",
        "content",
        "depth",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        F.when(called & answered, "linked").when(called, "no_result").otherwise("no_call").alias("status"),
        F.when(called, F.array_join(F.concat(problems(F.col("name"), F.col("arguments"), tools), F.when(F.col("depth").isNull(), F.array(F.lit("circle"))).otherwise(F.array().cast("array<string>"))), ", ")).otherwise("").alias("errors"),
    )
    record = F.struct(F.try_parse_json("arguments").alias("arguments"), "call_id", "conv_id", "depth", "name", F.col("content").alias("result"), "status", "turn")
    return rows.select("conv_id", "call_id", "turn", "name", "depth", "n_calls", "n_results", "status", "errors", F.to_json(record).alias("record"))


#: Tools of the messages below.
TOOLS = [
    Tool("lookup", (Field("query", "string"), Field("limit", "integer"))),
    Tool("count", (Field("what", "string"), Field("words", "boolean", required=False))),
    Tool("rewrite", (Field("text", "string"), Field("style", "object"))),
]


def messages(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results made of plain conversations: an assistant's turn is a call, what a user says next its result.

    The tool and its arguments follow from the turn's text, with defects of every kind in fixed shares; each call comes
    after the assistant's turn before it. Arguments hold the whole text; a null text is empty.
    """
    text, n = F.coalesce("text", F.lit("")), F.length(F.coalesce("text", F.lit("")))
    identifier = lambda back: F.concat(F.lit("call-"), F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit("-"), (F.col("turn") - back).cast("string"))
    limit = F.struct((n % 50).alias("limit"), F.when(n % 7 != 0, text).alias("query"))
    worded = F.struct((n % 50).cast("string").alias("limit"), F.when(n % 7 != 0, text).alias("query"))
    lookup = F.when(n % 11 == 0, F.to_json(worded)).otherwise(F.to_json(limit))
    count = F.to_json(F.struct(F.when(n % 5 == 0, F.lit("fast")).alias("mode"), text.alias("what"), (n % 2 == 0).alias("words")))
    rewrite = F.to_json(F.struct(F.struct((n % 5).alias("level")).alias("style"), text.alias("text")))
    broken = F.when(n % 13 == 0, F.left(rewrite, F.length(rewrite) - 1)).otherwise(rewrite)
    name = F.when(n % 3 == 0, "lookup").when(n % 3 == 1, "count").otherwise("rewrite")
    calls = conversations.where("role = 'assistant'").select(
        "conv_id", identifier(0).alias("call_id"), "turn", name.alias("name"), F.when(n % 3 == 0, lookup).when(n % 3 == 1, count).otherwise(broken).alias("arguments"), F.when(F.col("turn") >= 2, identifier(2)).alias("after")
    )
    results = conversations.where("role = 'user' and turn > 0").select("conv_id", identifier(1).alias("call_id"), "turn", text.alias("content"))
    return calls, results


def plain_messages(conversations: DataFrame) -> DataFrame:
    """The rows that are neither call nor result (system, opening user turns, other roles, no turn), as `link` has its rows,
    with status message and the text in the record."""
    taken = F.col("turn").isNotNull() & ((F.col("role") == "assistant") | ((F.col("role") == "user") & (F.col("turn") > 0)))
    rows = conversations.where(~F.coalesce(taken, F.lit(False))).withColumn("status", F.lit("message"))
    record = F.struct(F.coalesce("text", F.lit("")).alias("content"), "conv_id", "role", "status", "turn")
    none, zero = F.lit(None), F.lit(0).cast("long")
    return rows.select(
        "conv_id", none.cast("string").alias("call_id"), "turn", none.cast("string").alias("name"), none.cast("long").alias("depth"),
        zero.alias("n_calls"), zero.alias("n_results"), "status", F.lit("").alias("errors"), F.to_json(record).alias("record"),
    )


def linked_conversations(conversations: DataFrame) -> DataFrame:
    """Calls and results of conversations, linked, and all other rows as messages."""
    calls, results = messages(conversations)
    return link(calls, results, TOOLS).unionByName(plain_messages(conversations))


ORACLE = """
WITH RECURSIVE m AS (
    SELECT conv_id, turn, role, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM conversations
), calls AS (
    SELECT conv_id, turn, n,
        CASE n % 3 WHEN 0 THEN 'lookup' WHEN 1 THEN 'count' ELSE 'rewrite' END AS name,
        CASE n % 3
            WHEN 0 THEN '{"limit":' || CASE WHEN n % 11 = 0 THEN '"' || (n % 50) || '"' ELSE '' || (n % 50) END
                || CASE WHEN n % 7 <> 0 THEN ',"query":' || to_json(text) ELSE '' END || '}'
            WHEN 1 THEN '{' || CASE WHEN n % 5 = 0 THEN '"mode":"fast",' ELSE '' END || '"what":' || to_json(text)
                || ',"words":' || CASE WHEN n % 2 = 0 THEN 'true' ELSE 'false' END || '}'
            ELSE CASE WHEN n % 13 <> 0 THEN '{"style":{"level":' || (n % 5) || '},"text":' || to_json(text) || '}' END
        END AS arguments,
        CASE n % 3
            WHEN 0 THEN concat_ws(', ', CASE WHEN n % 7 = 0 THEN 'missing query' END, CASE WHEN n % 11 = 0 THEN 'type of limit' END)
            WHEN 1 THEN CASE WHEN n % 5 = 0 THEN 'unexpected mode' ELSE '' END
            ELSE CASE WHEN n % 13 = 0 THEN 'not a JSON object' ELSE '' END
        END AS errors
    FROM m WHERE role = 'assistant'
), chain AS (
    SELECT c.conv_id, c.turn, 0 AS depth FROM calls c
    WHERE NOT EXISTS (SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.turn - 2)
    UNION ALL
    SELECT c.conv_id, c.turn, chain.depth + 1 FROM chain JOIN calls c ON c.conv_id = chain.conv_id AND c.turn = chain.turn + 2
), results AS (
    SELECT conv_id, turn, turn - 1 AS call_turn, text FROM m WHERE role = 'user' AND turn > 0
), met AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.call_turn) AS call_turn, coalesce(c.turn, r.turn) AS turn,
        c.name, c.arguments, c.errors, d.depth, c.turn IS NOT NULL AS called, r.turn IS NOT NULL AS answered, r.text
    FROM calls c JOIN chain d ON c.conv_id = d.conv_id AND c.turn = d.turn
    FULL JOIN results r ON c.conv_id = r.conv_id AND c.turn = r.call_turn
), named AS (
    SELECT *, 'call-' || conv_id || '-' || call_turn AS call_id,
        CASE WHEN called AND answered THEN 'linked' WHEN called THEN 'no_result' ELSE 'no_call' END AS status
    FROM met
)
SELECT conv_id, call_id, turn, name, CAST(depth AS BIGINT) AS depth, CAST(called AS BIGINT) AS n_calls, CAST(answered AS BIGINT) AS n_results,
    status, coalesce(errors, '') AS errors,
    '{' || CASE WHEN arguments IS NOT NULL THEN '"arguments":' || arguments || ',' ELSE '' END
    || '"call_id":"' || call_id || '","conv_id":' || conv_id
    || CASE WHEN called THEN ',"depth":' || depth || ',"name":"' || name || '"' ELSE '' END
    || CASE WHEN answered THEN ',"result":' || to_json(text) ELSE '' END
    || ',"status":"' || status || '","turn":' || turn || '}' AS record
FROM named
UNION ALL
SELECT conv_id, NULL, turn, NULL, NULL, 0, 0, 'message', '',
    '{"content":' || to_json(text) || ',"conv_id":' || conv_id || ',"role":' || to_json(role) || ',"status":"message","turn":' || turn || '}'
FROM m WHERE NOT (role = 'assistant' OR (role = 'user' AND turn > 0))
"""
