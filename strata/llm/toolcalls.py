"""Chat formatting with tool-call linking, in DataFrame operations only.

Messages (conv_id, turn, role, text) become canonical chat rows, one a
message or call:

* An assistant's text that is a JSON object with ``tool_calls`` is one *call*
  for each entry {id, name, arguments, depends_on}, and, if it has ``content``
  beside them, a *message* of that before them (``pos`` -1).
* A tool's text that is a JSON object with ``tool_call_id`` is a *result*.
* A user's text is a call of the function ``reply`` with the argument
  ``prompt`` and the id "<conv_id>:<turn>"; an assistant's plain text is the
  result with the id of the turn before it, if that is a user's.
* Everything else is a *message*.

Calls and results are hash-joined by conversation and identifier.  Of several
calls (results) with one identifier the first counts, by turn, place and the
MD5 of the text; the others are marked.  Levels order calls topologically: 0
without dependencies, else one more than the highest call depended on; calls
on a cycle have no level, and one that depends on an identifier that the
conversation has no call of is not valid.  Arguments are validated against the
function's schema.  The JSON has sorted keys, no blanks, and names without values left
out.

No step gathers a conversation: rows stay rows, popular identifiers only
meet partial aggregates, and messages, which match nothing, join nothing; so
one conversation may hold any share of the table.

Cases: a null text is an empty one; null conversations, turns and roles are
values of their own (a null role is a message); white space before JSON is
none of its text; malformed JSON is plain text;
repeated rows each get their row; an empty table gives no rows; other columns
are ignored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

#: Function -> parameter -> (JSON type, required).  Types: string, number,
#: integer, boolean, object, array.
SCHEMAS = {"reply": {"prompt": ("string", True)}}

# How a variant's schema begins for each JSON type.
_TYPES = {"string": "^STRING", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL)", "integer": "^(BIGINT|DECIMAL[(][0-9]+,0[)])",
          "boolean": "^BOOLEAN", "object": "^OBJECT", "array": "^ARRAY"}

_CALL = "struct<id:string,name:string,arguments:variant,depends_on:array<string>>"


def _events(conv: DataFrame) -> DataFrame:
    """(conv_id, turn, pos, role, kind, call_id, name, args, depends, text)"""
    c = conv.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                    F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    may = F.col("role").isin("assistant", "tool") & F.col("text").rlike(r"^[ \t\r\n]*\{")
    c = c.withColumn("_json", F.when(may, F.try_parse_json("text")))
    c = c.withColumn("_calls", F.when(F.col("role") == "assistant", F.try_variant_get("_json", "$.tool_calls", "array<variant>")))
    c = c.withColumn("_answers", F.when(F.col("role") == "tool", F.try_variant_get("_json", "$.tool_call_id", "string")))
    own = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.coalesce(F.col("turn").cast("string"), F.lit("")))
    empty = F.lit(None).cast("array<string>")

    several = c.filter(F.size("_calls") > 0).select("conv_id", "turn", "role", "text", F.posexplode("_calls").alias("pos", "_c"))
    # arguments may be an object or its text
    several = several.withColumn("_a", F.expr("try_variant_get(_c, '$.arguments', 'variant')"))
    several = several.select(
        "conv_id", "turn", "pos", "role", F.lit("call").alias("kind"), F.try_variant_get("_c", "$.id", "string").alias("call_id"),
        F.try_variant_get("_c", "$.name", "string").alias("name"),
        F.when(F.schema_of_variant("_a") == "STRING", F.to_json(F.try_parse_json(F.try_variant_get("_a", "$", "string"))))
        .otherwise(F.to_json("_a")).alias("args"),
        F.try_variant_get("_c", "$.depends_on", "array<string>").alias("depends"), "text")

    beside = c.filter(F.size("_calls") > 0).withColumn("_content", F.try_variant_get("_json", "$.content", "string")).filter("_content != ''")
    none = F.lit(None).cast("string")
    beside = beside.select("conv_id", "turn", F.lit(-1).alias("pos"), "role", F.lit("message").alias("kind"), none.alias("call_id"), none.alias("name"),
                           none.alias("args"), empty.alias("depends"), F.col("_content").alias("text"))

    one = c.filter(F.coalesce(F.size("_calls"), F.lit(0)) <= 0)
    prompts = one.filter("role = 'user'").select("conv_id", F.col("turn").alias("_asked")).distinct()
    prompts = prompts.withColumn("_after", F.col("_asked") + 1).withColumn("_by", F.lit("assistant")).dropna(subset=["_after"])
    one = _join(one, prompts, "left", ("conv_id", "conv_id"), ("turn", "_after"), ("role", "_by"))
    asked = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.col("_asked").cast("string"))
    one = one.select(
        "conv_id", "turn", F.lit(0).alias("pos"), "role",
        F.when(F.col("role") == "user", "call").when(F.col("_answers").isNotNull() | F.col("_asked").isNotNull(), "result")
        .otherwise("message").alias("kind"),
        F.when(F.col("role") == "user", own).when(F.col("_answers").isNotNull(), F.col("_answers"))
        .when(F.col("_asked").isNotNull(), asked).alias("call_id"),
        F.when(F.col("role") == "user", "reply").alias("name"),
        F.when(F.col("role") == "user", F.to_json(F.struct(F.col("text").alias("prompt")))).alias("args"),
        empty.alias("depends"),
        F.when(F.col("_answers").isNotNull(), F.coalesce(F.try_variant_get("_json", "$.content", "string"), F.lit(""))).otherwise(F.col("text")).alias("text"))
    return several.unionByName(beside).unionByName(one)


def _errors(schemas: dict) -> Column:
    """What is wrong with ``args`` for ``name``, null if nothing: an array of
    texts, in the order of the schema, then unknown parameters by name."""
    values = F.expr("try_variant_get(try_parse_json(args), '$', 'map<string,variant>')")
    out = F.when(F.col("name").isNull(), F.array(F.lit("no function")))
    for name, params in schemas.items():
        checks = []
        for p, (kind, required) in sorted(params.items()):
            there = F.coalesce(F.array_contains(F.map_keys(values), p), F.lit(False))
            fits = F.coalesce(F.schema_of_variant(values[p]).rlike(_TYPES[kind]), F.lit(False))
            if required:
                checks.append(F.when(~there, F.lit(f"missing {p}")))
            checks.append(F.when(there & ~fits, F.lit(f"{p} is no {kind}")))
        unknown = F.array_sort(F.array_except(F.map_keys(values), F.array(*[F.lit(p) for p in params]) if params else F.array().cast("array<string>")))
        found = F.concat(F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>"),
                         F.transform(unknown, lambda x: F.concat(F.lit("unknown "), x)))
        out = out.when(F.col("name") == name, F.when(values.isNull(), F.array(F.lit("no object"))).otherwise(found))
    return out.otherwise(F.array(F.lit("unknown function")))


def _join(a: DataFrame, b: DataFrame, how: str, *pairs: tuple[str, str]) -> DataFrame:
    """Null-safe equi-join of columns (of a, of b); b's are dropped."""
    renamed = b
    cond = F.lit(True)
    for i, (x, y) in enumerate(pairs):
        renamed = renamed.withColumnRenamed(y, f"_j{i}")
        cond = cond & F.col(x).eqNullSafe(F.col(f"_j{i}"))
    return a.join(renamed, cond, how).drop(*[f"_j{i}" for i in range(len(pairs))])


def _first(events: DataFrame, kind: str, prefix: str) -> DataFrame:
    """Of each identifier of a conversation the first event of a kind."""
    place = F.struct(F.coalesce("turn", F.lit(-1 << 62)).alias("t"), "pos", F.md5("text").alias("m"), "turn")
    return events.filter((F.col("kind") == kind) & F.col("call_id").isNotNull()).groupBy("conv_id", "call_id") \
        .agg(F.min(place).alias(f"_{prefix}"))


def _levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) of the calls that depend on others: Kahn's
    rounds, each of which only reads the edges that are left."""
    spark = calls.sparkSession
    edges = calls.filter(F.size("depends") > 0).select("conv_id", "call_id", F.explode(F.array_distinct("depends")).alias("dep"))
    known = calls.select("conv_id", "call_id").distinct()
    on_dep = ("conv_id", "conv_id"), ("dep", "call_id")
    itself = ("conv_id", "conv_id"), ("call_id", "call_id")
    edges = common.stage(_join(edges, known, "left_semi", *on_dep), "edges")
    done, level = None, 0
    while not edges.isEmpty():
        level += 1
        waiting = edges.select("conv_id", "call_id").distinct()
        # a call is ready when nothing it depends on waits itself
        held = _join(edges, waiting, "left_semi", *on_dep).select("conv_id", "call_id").distinct()
        ready = common.stage(_join(waiting, held, "left_anti", *itself).withColumn("level", F.lit(level)), "levels")
        if ready.isEmpty():  # what is left lies on cycles, or behind them
            stuck = waiting.withColumn("level", F.lit(None).cast("int"))
            return stuck if done is None else done.unionByName(stuck)
        done = ready if done is None else done.unionByName(ready)
        edges = common.stage(_join(edges, ready, "left_anti", *itself), "edges")
    if done is None:
        return spark.createDataFrame([], "conv_id long, call_id string, level int")
    return done


def _unknown(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, _unknown): the identifiers that a call depends on
    and no call of its conversation has."""
    edges = calls.filter(F.size("depends") > 0).select("conv_id", "call_id", F.explode("depends").alias("dep")).distinct()
    lost = _join(edges, calls.select("conv_id", "call_id").distinct(), "left_anti", ("conv_id", "conv_id"), ("dep", "call_id"))
    return lost.groupBy("conv_id", "call_id").agg(F.array_sort(F.collect_set("dep")).alias("_unknown"))


def format_chats(conv: DataFrame, schemas: dict | None = None) -> DataFrame:
    """(conv_id, turn, pos, kind, call_id, linked_turn, level, valid, error,
    json).  ``linked_turn`` is the turn of a call's first result, or of a
    result's call; ``valid`` is null for messages."""
    schemas = SCHEMAS if schemas is None else schemas
    e = common.stage(_events(conv), "events")
    calls, results = _first(e, "call", "call"), _first(e, "result", "result")
    itself = ("conv_id", "conv_id"), ("call_id", "call_id")
    named = e.filter("kind = 'call' and call_id is not null")
    linked = e.filter("call_id is not null")
    for other in (calls, results, _levels(named).withColumn("_has", F.lit(True)), _unknown(named)):
        linked = _join(linked, other, "left", *itself)
    e = linked.unionByName(e.filter("call_id is null"), allowMissingColumns=True)
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"

    def extra(x):
        return ~(F.col(f"_{x}.turn").eqNullSafe(F.col("turn")) & (F.col(f"_{x}.pos") == F.col("pos")) & (F.col(f"_{x}.m") == F.md5("text")))

    e = e.withColumn("error", F.when(is_call, F.concat_ws(
        "; ", F.when(F.col("call_id").isNull(), "no identifier").when(extra("call"), "identifier repeated"),
        F.array_join(_errors(schemas), "; "), F.when(F.col("_has") & F.col("level").isNull(), "dependencies form a cycle"),
        F.when(F.col("_unknown").isNotNull(), F.concat(F.lit("depends on unknown "), F.array_join("_unknown", ", ")))))
        .when(is_result, F.concat_ws("; ", F.when(F.col("_call").isNull(), "no such call").when(extra("result"), "result repeated"))))
    e = e.withColumn("error", F.regexp_replace("error", "^; |; (?=; )|; $", ""))
    body = F.when(is_call, F.to_json(F.struct(
        F.try_parse_json("args").alias("arguments"), F.col("call_id").alias("id"), "name", F.lit("function").alias("type")))) \
        .when(is_result, F.to_json(F.struct(F.col("text").alias("content"), F.lit("tool").alias("role"), F.col("call_id").alias("tool_call_id")))) \
        .otherwise(F.to_json(F.struct(F.col("text").alias("content"), "role")))
    return e.select(
        "conv_id", "turn", "pos", "kind", "call_id",
        F.when(is_call, F.col("_result.turn")).when(is_result, F.col("_call.turn")).alias("linked_turn"),
        F.when(is_call, F.when(F.col("_has"), F.col("level")).otherwise(F.lit(0))).alias("level"),
        F.when(is_call | is_result, F.col("error") == "").alias("valid"), F.nullif("error", F.lit("")).alias("error"), body.alias("json"))
