"""Tool calls of conversations: linked to their results, ordered, validated and serialised.

Calls and results meet in a hash join on conversation and identifier: an identifier means something
within its conversation only, and calls without a conversation share one. A call may come after another, whose
result it uses; its level is the length of the chain before it, so levels are a topological
order: all that a call needs has a smaller one. Levels come from pointer doubling, in which every
round joins each call with the call it points to and doubles the distance it sees, so a chain of n calls
takes log2(n) rounds. Arguments are parsed and checked against their tool's schema, and each exchange is
written as canonical JSON: keys sorted at every depth, no white space.

It is DataFrame code throughout. Keys are aggregated before they are joined, so none repeats on
either side, and conversations of any length are spread. Rows of repeated keys meet the least of
their key in a join of its own, which may split a hot key's rows.

Defined results, by `status`: `ok`; `invalid`, with `errors`; `unanswered` for a call without result;
`orphan` for a result without call; `cyclic` for calls that wait for each other, or for one of
these, with no level; `nameless` for calls and results without identifier, each kept as it is; `duplicate` for
other calls and results under a key. The first that holds of nameless, duplicate, orphan, cyclic, invalid,
unanswered is given. Of calls that share a key the least is linked, of results the least text; `calls` and
`results` tell how many there were. Each that differs from it is a duplicate row, with no level and the number of
its equal copies. A call that comes after one unknown in its conversation comes after none.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabpulse.llm.scratch import stored
from fabpulse.session import settle

# JSON types by the first word of a variant's schema.
JSON_TYPES = {"string": ("STRING",), "integer": ("BIGINT",),
              "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "boolean": ("BOOLEAN",),
              "array": ("ARRAY",), "object": ("OBJECT",), "null": ("VOID",)}


@dataclass(frozen=True)
class Argument:
    """What an argument must be."""

    kind: str
    required: bool = True
    least: float | None = None
    most: float | None = None
    min_length: int = 0


Schema = Mapping[str, Argument]


def _path(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']"


def _argument_errors(parsed: Column, name: str, rule: Argument) -> list[Column]:
    value = F.variant_get(parsed, _path(name), "variant")
    kind = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    fits = kind.isin(*JSON_TYPES[rule.kind])
    checks = [F.when(value.isNull(), f"{name}: missing" if rule.required else None)
              .when(~fits, f"{name}: not of type {rule.kind}")]
    number = F.try_variant_get(parsed, _path(name), "double")
    if rule.least is not None:
        checks.append(F.when(fits & (number < rule.least), f"{name}: too small"))
    if rule.most is not None:
        checks.append(F.when(fits & (number > rule.most), f"{name}: too large"))
    if rule.min_length:
        text = F.try_variant_get(parsed, _path(name), "string")
        checks.append(F.when(fits & (F.length(text) < rule.min_length), f"{name}: too short"))
    return checks


def errors(schemas: Mapping[str, Schema], tool: str = "tool", arguments: str = "arguments") -> Column:
    """All that is wrong with a call, joined by semicolons; empty if nothing is."""
    parsed = F.try_parse_json(arguments)
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    found = F.array(F.lit("unknown tool"))
    for name, schema in schemas.items():
        extra = F.transform(
            F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, schema)).cast("array<string>")),
            lambda key: F.concat(key, F.lit(": not in the schema")))
        checks = [check for argument, rule in schema.items()
                  for check in _argument_errors(parsed, argument, rule)]
        wrong = F.concat(F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>"),
                         extra)
        found = F.when(F.col(tool) == name, wrong).otherwise(found)
    found = F.when(F.col(tool).isNull(), F.array(F.lit("unknown tool"))).when(
        ~is_object, F.array(F.lit("arguments: not an object"))).otherwise(found)
    return F.array_join(F.array_sort(found), "; ")


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) from (call_id, after), with unique ids: null in and behind cycles."""
    ids = calls.select(F.col("call_id").alias("known"))
    now = settle(
        calls.join(ids, F.col("after") == F.col("known"), "left")
        .select("call_id", F.col("known").alias("next"),
                F.col("known").isNotNull().cast("long").alias("steps")))
    total, seen = now.count(), 1
    while seen <= 2 * total and not now.where("next is not null").isEmpty():
        ahead = now.select(F.col("call_id").alias("next"), F.col("next").alias("beyond"),
                           F.col("steps").alias("more"))
        moved = now.where("next is not null").join(ahead, "next").select(
            "call_id", F.col("beyond").alias("next"), (F.col("steps") + F.col("more")).alias("steps"))
        now = settle(now.where("next is null").unionByName(moved))
        seen *= 2
    return now.select("call_id", F.when(F.col("next").isNull(), F.col("steps")).alias("level"))


def _key() -> Column:
    """Conversation and identifier in one column, never null itself, so joins on it are null-safe."""
    return F.struct("conv_id", "call_id")


def _others(rows: DataFrame, *columns: str) -> DataFrame:
    """(conv_id, call_id, *columns, copies) of what differs from the least row of its key."""
    named = rows.where("call_id is not null").select(_key().alias("key"), *columns)
    repeated = stored(named.groupBy("key").count().where("count > 1").select("key"), "repeated")
    if repeated.isEmpty():
        named = named.limit(0)  # most tables have none, and need not be shuffled for it
    each = stored(named.join(repeated, "key").groupBy("key", *columns)
                  .agg(F.count("*").alias("copies")), "variants")
    least = each.groupBy("key").agg(F.min(F.struct(*columns)).alias("least"))
    return each.join(least, "key").where(~F.struct(*columns).eqNullSafe(F.col("least"))).select(
        "key.*", *columns, "copies")


def link(calls: DataFrame, results: DataFrame, schemas: Mapping[str, Schema]) -> DataFrame:
    """One row per conversation and identifier, per duplicate, and per call or result without identifier.

    `calls` has call_id, conv_id, tool, arguments and after, `results` has call_id, conv_id and content.
    """
    named = stored(
        calls.where("call_id is not null").groupBy(_key().alias("key")).agg(
            F.min(F.struct("tool", "arguments", "after")).alias("call"),
            F.count("*").alias("calls")).select("key", "call.*", "calls"), "calls")
    answers = (
        results.where("call_id is not null").groupBy(_key().alias("key"))
        .agg(F.min(F.struct("content")).alias("answer"), F.count("*").alias("results"))
        .select("key", F.col("answer.content").alias("content"), "results")
    )
    after = F.when(F.col("after").isNotNull(), F.struct(
        F.col("key.conv_id").alias("conv_id"), F.col("after").alias("call_id")))
    met = (
        named.drop("after").hint("shuffle_hash").join(answers, "key", "full_outer")
        .join(levels(named.select(F.col("key").alias("call_id"), after.alias("after")))
              .withColumnRenamed("call_id", "key"), "key", "left")
        .select("key.*", "tool", "level", "calls", "results", "arguments", "content")
    )
    others = (
        _others(calls, "tool", "arguments", "after").drop("after").withColumnRenamed("copies", "calls")
        .unionByName(_others(results, "content").withColumnRenamed("copies", "results"),
                     allowMissingColumns=True)
        .withColumn("duplicate", F.lit(True))
    )
    loose = calls.where("call_id is null").select(
        "conv_id", "tool", "arguments", F.lit(1).cast("long").alias("calls")).unionByName(
        results.where("call_id is null").select(
            "conv_id", "content", F.lit(1).cast("long").alias("results")), allowMissingColumns=True)
    rows = others.unionByName(met, allowMissingColumns=True).unionByName(loose, allowMissingColumns=True)
    none = F.lit(0).cast("long")
    judged = rows.select(
        "conv_id", "call_id", "tool", "level", "duplicate",
        F.coalesce("calls", none).alias("calls"), F.coalesce("results", none).alias("results"),
        "arguments", "content",
        F.when(F.col("calls").isNotNull(), errors(schemas)).otherwise("").alias("errors"))
    status = (
        F.when(F.col("call_id").isNull(), "nameless").when(F.col("duplicate"), "duplicate")
        .when(F.col("calls") == 0, "orphan")
        .when(F.col("level").isNull(), "cyclic").when(F.col("errors") != "", "invalid")
        .when(F.col("results") == 0, "unanswered").otherwise("ok"))
    message = F.to_json(F.struct(
        F.try_parse_json("arguments").alias("arguments"), F.col("call_id").alias("id"),
        F.col("tool").alias("name"), F.col("content").alias("result")))
    return judged.select("conv_id", "call_id", "tool", "level", "calls", "results", "errors",
                         status.alias("status"), message.alias("message"))


# The exchanges that the registered query reads out of plain conversations: a user's turn calls a
# tool, the assistant's turn after it is the result, and a call comes after the one two turns before.
SCHEMAS: dict[str, Schema] = {
    "search": {"query": Argument("string", min_length=1), "limit": Argument("integer", least=1, most=64),
               "page": Argument("integer", least=0)},
    "lookup": {"query": Argument("string", min_length=1), "limit": Argument("integer", least=1, most=256),
               "page": Argument("integer", required=False, least=0, most=6)},
}


def conversation_calls(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of (conv_id, turn, role, text)."""
    def call_id(turn: Column) -> Column:
        return F.concat(F.lit("call_"), F.col("conv_id"), F.lit("_"), turn.cast("string"))

    turn = F.col("turn")
    calls = turns.where("role = 'user'").select(
        call_id(turn).alias("call_id"), "conv_id",
        F.when(turn % 3 == 0, "search").otherwise("lookup").alias("tool"),
        F.to_json(F.struct(
            F.col("text").alias("query"), turn.alias("page"),
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).alias("limit"))).alias("arguments"),
        call_id(turn - 2).alias("after"))
    results = turns.where("role = 'assistant'").select(
        call_id(turn - 1).alias("call_id"), "conv_id", F.col("text").alias("content"))
    return calls, results


# For DuckDB, over conversations in which (conv_id, turn) and texts are not null and don't repeat.
ORACLE = r"""
WITH u AS (
    SELECT conv_id, turn, text, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
           turn - 2 * row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS island
    FROM conversations WHERE role = 'user'),
c AS (
    SELECT conv_id, 'call_' || conv_id || '_' || turn AS call_id, text, words, turn,
           CASE WHEN turn % 3 = 0 THEN 'search' ELSE 'lookup' END AS tool,
           row_number() OVER (PARTITION BY conv_id, turn % 2, island ORDER BY turn) - 1 AS level
    FROM u),
r AS (SELECT conv_id AS of_conv, 'call_' || conv_id || '_' || (turn - 1) AS call_id, text AS content
      FROM conversations WHERE role = 'assistant'),
j AS (
    SELECT coalesce(conv_id, of_conv) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, tool,
           level, (c.call_id IS NOT NULL)::BIGINT AS calls, (r.call_id IS NOT NULL)::BIGINT AS results,
           CASE WHEN c.call_id IS NULL THEN '' ELSE concat_ws('; ',
               CASE WHEN tool = 'search' AND words > 64 OR words > 256 THEN 'limit: too large'
                    WHEN words < 1 THEN 'limit: too small' END,
               CASE WHEN tool = 'lookup' AND turn > 6 THEN 'page: too large' END,
               CASE WHEN text = '' THEN 'query: too short' END) END AS errors,
           text, words, turn, content
    FROM c FULL JOIN r ON c.call_id = r.call_id)
SELECT conv_id, call_id, tool, level, calls, results, errors,
       CASE WHEN calls = 0 THEN 'orphan' WHEN errors <> '' THEN 'invalid'
            WHEN results = 0 THEN 'unanswered' ELSE 'ok' END AS status,
       '{' || concat_ws(',',
           CASE WHEN calls = 1 THEN '"arguments":{"limit":' || words || ',"page":' || turn || ',"query":'
                || to_json(text) || '}' END,
           '"id":' || to_json(call_id), '"name":' || to_json(tool), '"result":' || to_json(content))
       || '}' AS message
FROM j
"""
