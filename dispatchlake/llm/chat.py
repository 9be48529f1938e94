"""Chat formatting with linked tool calls, in DataFrame operations only.

A message's text may be a JSON object: an assistant's with ``tool_calls`` (``id``, ``name``, ``arguments``), a
tool's with ``tool_call_id``; any other text is plain content. Calls and results are joined by conversation
and identifier. A result takes the place of its own turn, or the place behind its call where it came before
it, so (place_turn, place_depth, turn) orders every call ahead of its results. Arguments are checked against the
tool's schema: every required one present, none that the schema does not name, each of the named JSON type.
Schemas are those that the system turns of the call's own conversation state (a JSON object with ``tools``, each
with ``name`` and ``parameters``, there or under ``function``), and for other names the given ``tools``.
Messages are serialised as canonical JSON: keys in order, no white space, absent parts left out.

One row per message: no conversation, however long, is gathered in one place.

Defined results: a null text is null content, an empty one empty content; a null role is left out; text that
is no JSON object, or has no tool fields, is plain content; a call without id, or whose id an earlier call of
the conversation has, links with nothing; a result without a call has ``linked`` false; repeated rows give
repeated messages; messages without conversation or turn are formatted, not linked; a system turn that states tools
is plain content as well; a stated tool without parameters takes none, an argument without one named type any value,
and a tool that a conversation states in two ways is unknown there; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TOOLS = "name string, required array<string>, properties map<string,string>"
ANY = "any"  # the type of an argument whose schema names none, or several


def no_tools(spark: SparkSession) -> DataFrame:
    columns = [c.strip().split(" ") for c in TOOLS.split(", ")]
    return spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in columns])


def _json_type(value: Column) -> Column:
    """The JSON type of a variant."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind == "BIGINT", "integer")
        .when(kind == "VOID", "null")
        .otherwise("number")
    )


def tool_calls(parsed: DataFrame) -> DataFrame:
    """One row per call: row_key, conv_id, turn, nth, call_id, name, arguments (variant)."""
    calls = parsed.filter(F.col("calls").isNotNull()).select(
        "row_key", "conv_id", "turn", F.posexplode("calls").alias("nth", "call")
    )
    get = lambda path, kind: F.try_variant_get("call", path, kind)
    return calls.select(
        "row_key",
        "conv_id",
        "turn",
        "nth",
        get("$.id", "string").alias("call_id"),
        get("$.name", "string").alias("name"),
        get("$.arguments", "variant").alias("arguments"),
    )


def stated_tools(parsed: DataFrame) -> DataFrame:
    """The tools that system turns state: conv_id, name, times, required, properties."""
    listed = F.try_variant_get("json", "$.tools", "array<variant>")
    turns = parsed.filter((F.col("role") == "system") & F.col("conv_id").isNotNull()).select("conv_id", listed.alias("tools"))
    either = lambda path, kind: F.coalesce(
        F.try_variant_get("tool", f"$.function.{path}", kind), F.try_variant_get("tool", f"$.{path}", kind)
    )
    one_type = lambda name, schema: F.when(
        F.schema_of_variant(F.try_variant_get(schema, "$.type", "variant")) == "STRING",
        F.try_variant_get(schema, "$.type", "string"),
    )
    tools = (
        turns.filter("tools is not null")
        .select("conv_id", F.explode("tools").alias("tool"))
        .select(
            "conv_id",
            either("name", "string").alias("name"),
            either("parameters.required", "array<string>").alias("required"),
            either("parameters.properties", "map<string,variant>").alias("schemas"),
        )
        .filter("name is not null")
    )
    typed = F.transform_values("schemas", lambda name, schema: F.coalesce(one_type(name, schema), F.lit(ANY)))
    none = F.create_map().cast("map<string,string>")
    tools = tools.select("conv_id", "name", "required", F.coalesce(typed, none).alias("properties"))
    # The same statement may come twice.
    said = F.to_json(F.struct(F.array_sort("required").alias("r"), F.array_sort(F.map_entries("properties")).alias("p")))
    return tools.groupBy("conv_id", "name").agg(
        F.count_distinct(said).alias("times"), F.first("required").alias("required"), F.first("properties").alias("properties")
    )


def checked(calls: DataFrame, tools: DataFrame, stated: DataFrame) -> DataFrame:
    """Calls with ``valid``. Tools are unique by name; those named twice are taken as unknown.

    What the call's conversation states about a name counts before ``tools``.
    """
    single = tools.groupBy("name").agg(
        F.count(F.lit(1)).alias("times"), F.first("required").alias("required"), F.first("properties").alias("properties")
    )
    own = F.col("said.times").isNotNull()
    once = F.col("said.times") == 1
    known = (
        calls.alias("call")
        .join(stated.alias("said"), F.expr("call.conv_id = said.conv_id and call.name = said.name"), "left")
        .select(
            "call.*",
            own.alias("own"),
            F.when(once, F.col("said.required")).alias("own_required"),
            F.when(once, F.col("said.properties")).alias("own_properties"),
        )
        .join(single.filter("times = 1").drop("times"), "name", "left")
        .withColumn("required", F.when(F.col("own"), F.col("own_required")).otherwise(F.col("required")))
        .withColumn("properties", F.when(F.col("own"), F.col("own_properties")).otherwise(F.col("properties")))
        .drop("own", "own_required", "own_properties")
    )
    given = F.try_variant_get("arguments", "$", "map<string,variant>")
    wanted = F.col("properties")
    typed = F.forall(
        F.map_entries("given"),
        lambda e: F.coalesce(
            (wanted[e["key"]] == _json_type(e["value"]))
            | (wanted[e["key"]] == ANY)
            | ((wanted[e["key"]] == "number") & (_json_type(e["value"]) == "integer")),
            F.lit(False),
        ),
    )
    has_all = F.forall(F.coalesce("required", F.array().cast("array<string>")), lambda r: F.map_contains_key("given", r))
    valid = F.col("properties").isNotNull() & F.col("given").isNotNull() & has_all & typed
    return known.withColumn("given", given).withColumn("valid", F.coalesce(valid, F.lit(False))).drop(
        "given", "required", "properties"
    )


def format_chat(messages: DataFrame, tools: DataFrame | None = None) -> DataFrame:
    """One row per message: conv_id, turn, place_turn, place_depth, role, n_calls, n_valid, linked, message."""
    spark = messages.sparkSession
    tools = no_tools(spark) if tools is None else tools
    rows = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    json = F.when(F.ltrim("text").startswith("{"), F.try_parse_json("text"))
    parsed = (
        rows.withColumn("json", json)
        .withColumn("calls", F.when(F.col("role") == "assistant", F.try_variant_get("json", "$.tool_calls", "array<variant>")))
        .withColumn("answers", F.when(F.col("role") == "tool", F.try_variant_get("json", "$.tool_call_id", "string")))
        .withColumn("row_key", F.xxhash64("conv_id", "turn", "role", "text"))
    )
    calling = parsed.filter(F.col("calls").isNotNull()).dropDuplicates(["conv_id", "turn", "role", "text"])
    calls = checked(tool_calls(calling), tools, stated_tools(parsed))
    owners = (
        calls.filter("call_id is not null and conv_id is not null and turn is not null")
        .groupBy("conv_id", "call_id")
        .agg(F.min("turn").alias("call_turn"))
    )
    one = F.struct(
        "nth",
        F.struct("arguments", F.col("call_id").alias("id"), "name", "valid").alias("c"),
    )
    text_of = F.to_json(F.col("x.c.arguments"))
    listed = (
        calls.select("row_key", "conv_id", "turn", "valid", one.alias("x"))
        .select(
            "row_key",
            "conv_id",
            "turn",
            "valid",
            F.struct(
                F.col("x.nth").alias("nth"),
                F.concat(
                    F.lit('{"arguments":'),
                    F.coalesce(text_of, F.lit("null")),
                    F.lit(',"id":'),
                    _quoted(F.col("x.c.id")),
                    F.lit(',"name":'),
                    _quoted(F.col("x.c.name")),
                    F.lit(',"valid":'),
                    F.col("x.c.valid").cast("string"),
                    F.lit("}"),
                ).alias("text"),
            ).alias("item"),
        )
        .groupBy("row_key", "conv_id", "turn")
        .agg(
            F.count(F.lit(1)).alias("n_calls"),
            F.sum(F.col("valid").cast("long")).alias("n_valid"),
            F.array_sort(F.collect_list("item")).alias("items"),
        )
    )
    # Only messages with tool fields go through the joins; all others stay where they are.
    used = F.col("calls").isNotNull() | F.col("answers").isNotNull()
    plain = parsed.filter(~F.coalesce(used, F.lit(False)))
    tooled = (
        parsed.filter(F.coalesce(used, F.lit(False)))
        .alias("m")
        .join(listed.alias("c"), F.expr("m.row_key = c.row_key and m.conv_id <=> c.conv_id and m.turn <=> c.turn"), "left")
        .join(owners.alias("o"), F.expr("m.conv_id = o.conv_id and m.answers = o.call_id"), "left")
        .select("m.*", "c.n_calls", "c.n_valid", "c.items", "o.call_turn")
    )
    none = plain.select(
        "*",
        F.lit(None).cast("long").alias("n_calls"),
        F.lit(None).cast("long").alias("n_valid"),
        F.lit(None).cast("array<struct<nth:int,text:string>>").alias("items"),
        F.lit(None).cast("long").alias("call_turn"),
    )
    late = F.col("call_turn").isNotNull() & (F.col("call_turn") >= F.col("turn"))
    content = F.when(
        F.col("calls").isNotNull() | F.col("answers").isNotNull(), F.try_variant_get("json", "$.content", "string")
    ).otherwise(F.col("text"))
    part = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), value))
    message = F.concat(
        F.lit("{"),
        F.concat_ws(
            ",",
            part("content", F.when(content.isNull(), F.lit("null")).otherwise(_quoted(content))),
            part("role", F.when(F.col("role").isNotNull(), _quoted(F.col("role")))),
            part("tool_call_id", F.when(F.col("answers").isNotNull(), _quoted(F.col("answers")))),
            part(
                "tool_calls",
                F.when(
                    F.col("items").isNotNull(),
                    F.concat(F.lit("["), F.array_join(F.transform("items", lambda i: i["text"]), ","), F.lit("]")),
                ),
            ),
        ),
        F.lit("}"),
    )
    return tooled.unionByName(none).select(
        "conv_id",
        "turn",
        F.when(late, F.col("call_turn")).otherwise(F.col("turn")).alias("place_turn"),
        F.when(late, 1).otherwise(0).alias("place_depth"),
        "role",
        F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
        F.coalesce("n_valid", F.lit(0)).cast("long").alias("n_valid"),
        F.when(F.col("answers").isNotNull(), F.col("call_turn").isNotNull()).alias("linked"),
        message.alias("message"),
    )


def _quoted(text: Column) -> Column:
    """A JSON string, or null: what ``to_json`` writes behind the one key, without the closing brace."""
    whole = F.to_json(F.struct(text.alias("s")))
    return F.when(text.isNull(), F.lit("null")).otherwise(whole.substr(F.lit(6), F.length(whole) - 6))
